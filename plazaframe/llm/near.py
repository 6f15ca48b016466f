"""Near-duplicate texts by Order MinHash.

Words are what white space separates, in lower case; a text is the sequence of its runs of five
words, each labelled with how often it has occurred before (fewer words make one run). A sketch holds the ``TAKEN`` labelled runs
with the least hash values in the order of the text, so that two texts share it only if they agree
on runs and order. Texts that share one of ``SKETCHES`` sketches are candidates, and a banded
alignment verifies them: with c runs that can be aligned in order, two texts of n and m runs are
similar as c / (n + m - c), and linked from ``SIMILARITY`` on. Two long texts at the threshold share no sketch about
three times in a million. Short ones do so more often (8 of 10 runs 3 in ten thousand, 4 of 5 always), so texts of at most ``SHORT``
runs also share each sequence that is left of them without the runs a similar text may lack: among them no pair is missed. The most
likely to be missed are then 12 of 15 runs, 6 times in 100,000.

Equal texts are one node, whatever their number. Within a group that shares a sketch not all pairs
are aligned. First all members are aligned with one of them, the pivot (the one that shares most with
others), and the links found make components. Only where a group then holds several components, its members are reduced to how they differ from
the runs that most members of their pivot's groups have. Those differences tell of any pair how many runs it shares at most: members
with few differences are aligned with the one that has the fewest, and a member that is still outside meets the likeliest text of each other
component, and if that fails all those texts of it that the differences leave possible. So every pair that shares a
sketch is aligned, or proven dissimilar, or connected already; nothing is capped. Links make classes by
connected components, and a class is named by its smallest id.

Null texts and texts without words are alike to nothing: each row is its own class. Rows with equal texts (white space and
case aside) are one class, so are repeated rows. A null id never names a class that has other ids.
An empty table gives no rows. Columns that are not named are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.llm.components import components
from plazaframe.llm.shingles import labelled, mix, word_hashes, word_runs
from plazaframe.llm.worker import give_back
from plazaframe.operators.durable import materialise

WORDS = 5
SIMILARITY = 0.8
TAKEN = 5
SKETCHES = 32
#: Up to so many runs candidates are exact; at the similarity of 0.8 at most 1 + 14 + 91 sequences a text.
SHORT = 14
#: Runs of a text for which all sketches are computed in one array.
AT_ONCE = 20_000
#: Members, and runs in which they differ from the rest of their group, on one side of a block.
BLOCK, BLOCK_RUNS = 250, 500_000
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64))


def text_key(text: str) -> bytes | None:
    """128 bits that stand for the words of a text; None without words."""
    words = text.lower().encode().split()
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def runs_of(text: str) -> np.ndarray:
    return labelled(word_runs(word_hashes(text), WORDS))


def sketches(runs: np.ndarray) -> np.ndarray:
    """The Order MinHash sketches of a text, each as one number."""
    n = min(TAKEN, len(runs))
    if len(runs) <= AT_ONCE:
        values = mix(runs[None, :] ^ _SEEDS[:, None])
        least = np.argpartition(values, n - 1, axis=1)[:, :n] if n < len(runs) else np.tile(np.arange(n), (SKETCHES, 1))
    else:
        least = np.stack([np.argpartition(mix(runs ^ seed), n - 1)[:n] for seed in _SEEDS])
    ordered = runs[np.sort(least, axis=1)]  # as in the text
    out = _SEEDS.copy()
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + ordered[:, i])
    return out


@cache
def _left(n: int, size: int) -> np.ndarray:
    """The places of every choice of ``size`` out of n runs, in order."""
    return np.array(list(combinations(range(n), size)))


def remainders(runs: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """A number for each sequence left of a short text without runs that a similar text may lack; none for longer texts."""
    n, out = len(runs), [np.empty(0, np.uint64)]
    for size in range(n, 0, -1) if n <= SHORT else ():
        if size < similarity * n - 1e-9:
            break
        chosen = runs[_left(n, size)]
        numbers = np.full(len(chosen), size, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(size):
                numbers = mix(numbers * np.uint64(0xD6E8FEB86659FD93) + chosen[:, i])
        out.append(numbers)
    return np.concatenate(out)


class Aligner:
    """Aligns texts with a pivot, within the band that distances up to ``reach`` need."""

    def __init__(self, pivot: np.ndarray, reach: float):
        self.order = np.argsort(pivot)
        self.ordered, self.n, self.reach = pivot[self.order], len(pivot), reach

    def distance(self, other: np.ndarray) -> float:
        """1 - c / (n + m - c); any value above ``reach`` means at least ``reach``."""
        total = self.n + len(other)
        band = int(total * self.reach / (2 - self.reach) + 1e-9)  # insertions and deletions within reach
        place = np.searchsorted(self.ordered, other)
        place[place == self.n] = 0
        hit = self.ordered[place] == other
        at = self.order[place[hit]]
        at = at[np.abs(at - np.flatnonzero(hit)) <= band]
        if len(at) < 2 or (np.diff(at) > 0).all():
            common = len(at)
        else:
            ends: list[int] = []
            for x in at.tolist():
                i = bisect_left(ends, x)
                if i == len(ends):
                    ends.append(x)
                else:
                    ends[i] = x
            common = len(ends)
        return 1 - common / (total - common)


def _signatures(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """id, key, number of runs, and sketches (of short texts also the remainders) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, known = [], {}
            for text in batch.column(1):
                text = text.as_py() or ""
                key = text_key(text)
                if key is None:
                    made = (None, 0, None)
                elif (made := known.get(key)) is None:
                    runs = runs_of(text)
                    made = known[key] = (key, len(runs), np.concatenate((sketches(runs), remainders(runs, similarity))).view(np.int64))
                rows.append(made)
            columns = [pa.array([row[i] for row in rows], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.list_(pa.int64())))]
            yield pa.record_batch([batch.column(0), *columns], ["id", "key", "n", "sketches"])
            del rows, known, columns
        give_back()

    return docs.mapInArrow(run, "id long, key binary, n long, sketches array<long>")


def _keyed_texts(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([text_key(t.as_py() or "") for t in batch.column(1)], pa.binary()), batch.column(1)], ["key", "text"])

    return docs.mapInArrow(run, "key binary, text string").where("key IS NOT NULL").groupBy("key").agg(F.first("text").alias("text"))


def _aligned(pairs: DataFrame, texts: DataFrame, reach: float) -> DataFrame:
    """pivot, key and distance of each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, aligner = None, None
        for batch in batches:
            out = []
            for pivot, text, other in zip(batch["pivot"].to_pylist(), batch["pivot_text"], batch["text"], strict=True):
                if pivot != held:
                    held, aligner = pivot, Aligner(runs_of(text.as_py()), reach)
                out.append(aligner.distance(runs_of(other.as_py())))
            yield pa.record_batch([batch["pivot"], batch["key"], pa.array(out, pa.float64())], ["pivot", "key", "distance"])
        give_back()

    with_pivot = pairs.join(texts.select(F.col("key").alias("pivot"), F.col("text").alias("pivot_text")), "pivot")
    with_both = with_pivot.join(texts, "key").select("pivot", "key", "pivot_text", "text")
    return with_both.mapInArrow(run, "pivot binary, key binary, distance double")


def _runs(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """key and labelled runs of some texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                runs = pa.array([runs_of(t.as_py()).view(np.int64) for t in part["text"]], pa.list_(pa.int64()))
                yield pa.record_batch([part["key"], runs], ["key", "runs"])
        give_back()

    return texts.join(keys, "key", "left_semi").select("key", "text").mapInArrow(run, "key binary, runs array<long>")


def _differences(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """How each member (pivot, key, n) of a pivot's groups differs from what most of its members have in common.

    ``differs`` are the runs that only the member or only the common set has, without those that tell no two members alike; ``far`` is the
    number of all of them less the member's part of the differences a similar pair may have. With x runs among the differences of both, two
    members have all their differences but 2x between them, so they can be similar only if x is at least half the sum of their ``far``.
    """
    sized = materialise(members.join(members.groupBy("pivot").agg(F.count("*").alias("members")), "pivot"))
    whole = sized.join(materialise(_runs(texts, members.select("key").distinct())), "key")
    counted = whole.select("pivot", "members", F.explode("runs").alias("run")).groupBy("pivot", "run")
    counted = counted.agg(F.count("*").alias("having"), F.first("members").alias("members"))
    counted = materialise(counted.where("having > 1"))  # a run of one member tells no two alike, and is not common
    common = F.col("having") * 2 > F.col("members")
    core = counted.where(common).groupBy("pivot").agg(F.collect_list("run").alias("core"))  # at most twice the runs of a member
    telling = counted.where(F.when(common, F.col("members") - F.col("having")).otherwise(F.col("having")) > 1).select("pivot", "run")
    core_runs = F.coalesce("core", F.array().cast("array<long>"))
    against = F.concat(F.array_except("runs", core_runs), F.array_except(core_runs, "runs"))
    found = whole.join(core, "pivot", "left").select("pivot", "key", "n", against.alias("against"))
    far = F.size("against") - F.col("n") * F.lit((1 - similarity) / (1 + similarity))
    found = materialise(found.select("pivot", "key", far.alias("far"), "against"))
    shared = found.select("pivot", "key", F.explode("against").alias("run")).join(telling, ["pivot", "run"], "left_semi")
    shared = shared.groupBy("pivot", "key").agg(F.collect_list("run").alias("differs"))
    return found.drop("against").join(shared, ["pivot", "key"], "left").withColumn("differs", F.coalesce("differs", F.array().cast("array<long>")))


def _block_pairs(every: bool) -> Callable[[pa.Table], pa.Table]:
    """Of one block, the pairs of an outside member and one of another component that their differences do not prove dissimilar.

    Without ``every`` only the likeliest pair for each outside member and component.
    """

    def run(block: pa.Table) -> pa.Table:
        outside = block["outside"].to_numpy()
        root = block["root"].combine_chunks().dictionary_encode().indices.to_numpy()
        far, sizes = block["far"].to_numpy(), pc.list_value_length(block["differs"]).to_numpy()
        runs = np.split(pc.list_flatten(block["differs"]).to_numpy(), np.cumsum(sizes)[:-1])
        others = np.flatnonzero(~outside)
        owners = np.repeat(np.arange(len(others)), sizes[others])
        held = np.concatenate([runs[i] for i in others] or [np.empty(0, np.int64)])
        order = np.argsort(held, kind="stable")
        held, owners = held[order], owners[order]
        a, b, margin = [], [], []
        for i in np.flatnonzero(outside):
            start, end = np.searchsorted(held, runs[i], "left"), np.searchsorted(held, runs[i], "right")
            met = [owners[x:y] for x, y in zip(start, end, strict=True) if x < y]
            both = np.bincount(np.concatenate(met) if met else np.empty(0, np.int64), minlength=len(others))
            spare = both - (far[i] + far[others]) / 2
            found = np.flatnonzero((spare >= -1e-6) & (root[others] != root[i]))
            if not every:
                found = found[np.argsort(-spare[found], kind="stable")]
                found = found[np.unique(root[others[found]], return_index=True)[1]]
            a += [i] * len(found)
            b += others[found].tolist()
            margin += spare[found].tolist()
        pairs = [block["key"].take(pa.array(a, pa.int64())), block["key"].take(pa.array(b, pa.int64())), block["root"].take(pa.array(b, pa.int64()))]
        return pa.table([*pairs, pa.array(margin, pa.float64())], ["a", "b", "root", "margin"])

    return run


def _unproven(outside: DataFrame, members: DataFrame, every: bool) -> DataFrame:
    """Pairs (a, b) of outside members with members of other components, that may be similar, with the root of b.

    Both sides of a pivot's groups are dealt into parts of about ``BLOCK`` members, or ``BLOCK_RUNS`` differing runs, and each part meets each,
    so that a block has a size of its own and the blocks of a large group are many tasks.
    """

    def parts(df: DataFrame, out: str) -> DataFrame:
        runs = F.sum(F.size("differs"))
        return df.groupBy("pivot").agg(F.ceil(F.greatest(F.count("*") / BLOCK, runs / BLOCK_RUNS)).cast("int").alias(out))

    dealt = materialise(parts(outside, "lefts").join(parts(members, "rights"), "pivot"))

    def side(df: DataFrame, left: bool) -> DataFrame:
        own, other = ("lefts", "rights") if left else ("rights", "lefts")
        at = F.pmod(F.xxhash64("key"), own).cast("int").alias("at")
        meets = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("meets")
        placed = df.join(dealt, "pivot").select("pivot", "key", "root", "far", "differs", at, meets)
        i, j = ("at", "meets") if left else ("meets", "at")
        return placed.select("pivot", F.col(i).alias("i"), F.col(j).alias("j"), "key", "root", "far", "differs", F.lit(left).alias("outside"))

    blocks = side(outside, True).union(side(members, False)).groupBy("pivot", "i", "j")
    found = blocks.applyInArrow(_block_pairs(every), "a binary, b binary, root binary, margin double")
    return found if every else found.groupBy("a", "root").agg(F.max_by("b", F.struct("margin", "b")).alias("b"))


def links(docs: DataFrame, signatures: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b) of keys whose texts are similar; enough of them to connect each class."""
    limit = 1 - similarity
    nodes = signatures.where("key IS NOT NULL").groupBy("key")
    groups = nodes.agg(F.first("sketches").alias("sketches")).select("key", F.explode("sketches").alias("bucket"))
    shared = groups.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = materialise(groups.join(shared, "bucket").select("bucket", "key", "size"))
    # the text that shares most with others is the one most of a group's texts are likely to be similar to
    central = members.groupBy("key").agg(F.sum("size").alias("central"))
    facts = nodes.agg(F.first("n").alias("n")).join(central, "key")
    members = materialise(members.join(facts, "key").select("bucket", "key", "n", "central"))
    texts = materialise(_keyed_texts(docs).join(members.select("key").distinct(), "key", "left_semi"))

    def similar(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose alignment says so."""
        ends = pairs.select(F.col("a").alias("pivot"), F.col("b").alias("key"))
        return _aligned(ends, texts, limit).where(F.col("distance") <= limit).select(F.col("pivot").alias("a"), F.col("key").alias("b"))

    def rooted(df: DataFrame, roots: DataFrame) -> DataFrame:
        return df.join(roots, df["key"] == roots["node"], "left").select(*df.columns, F.coalesce("root", "key").alias("root"))

    pivots = members.groupBy("bucket").agg(F.max(F.struct("central", "key", "n")).alias("p"))
    pivots = pivots.select("bucket", F.col("p.key").alias("pivot"), F.col("p.n").alias("other_n"))
    meets = materialise(members.join(pivots, "bucket").select("bucket", "pivot", "key", "n", "other_n"))
    apart = 1 - F.least("n", "other_n") / F.greatest("n", "other_n")  # at least, by their lengths alone
    first = meets.where((F.col("key") != F.col("pivot")) & (apart <= limit)).select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct()
    linked = materialise(similar(first))

    # groups in several components; those of one pivot are worked on together
    judged = rooted(meets.select("bucket", "pivot", "key", "n"), materialise(components(linked)))
    several = judged.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("bucket")
    judged = materialise(judged.join(several, "bucket", "left_semi").select("pivot", "key", "n", "root").distinct())
    differing = materialise(_differences(judged.select("pivot", "key", "n"), texts, similarity).join(judged.select("pivot", "key", "root"), ["pivot", "key"]))

    # any two members that are similar whatever runs they share are so to the one with the fewest differences
    nearest = differing.groupBy("pivot").agg(F.min(F.struct("far", "key", "root")).alias("nearest"))
    nearest = materialise(nearest.select("pivot", F.col("nearest.key").alias("a"), F.col("nearest.far").alias("a_far"), F.col("nearest.root").alias("a_root")))
    star = differing.join(nearest, "pivot").where((F.col("far") + F.col("a_far") <= 1e-6) & (F.col("root") != F.col("a_root")))
    star = materialise(similar(star.select("a", F.col("key").alias("b")).distinct()))
    linked = materialise(linked.union(star))

    # the members outside the component of that one against those of other components
    now = materialise(rooted(differing.drop("root"), materialise(components(linked))))
    mains = rooted(nearest.select("pivot", F.col("a").alias("key")), now.select(F.col("key").alias("node"), "root").distinct())
    outside = materialise(now.join(mains.select("pivot", F.col("root").alias("main")), "pivot").where("root <> main").drop("main"))
    likeliest = materialise(_unproven(outside, now, False))
    joined = materialise(similar(likeliest.select("a", "b").distinct()))
    # runs in another order can make the likeliest pair dissimilar; then the member meets all of that component
    failed = materialise(likeliest.join(joined, ["a", "b"], "left_anti").select("a", "root"))
    again = outside.join(failed.select(F.col("a").alias("key")), "key", "left_semi")
    rest = _unproven(again, now, True).join(failed, ["a", "root"], "left_semi").select("a", "b").distinct()
    return linked.union(joined).union(similar(rest))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """id, class_id (the smallest id of the row's class) and n_texts, the different texts in the class."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signatures = materialise(_signatures(slim, similarity))
    found = materialise(links(slim, signatures, similarity))
    roots = components(found)
    ids = signatures.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("least"))
    rooted = materialise(ids.join(roots, ids["key"] == roots["node"], "left").select("key", "least", F.coalesce("root", "key").alias("root")))
    classes = rooted.groupBy("root").agg(F.min("least").alias("class_id"), F.count("*").alias("n_texts"))
    named = rooted.join(classes, "root").select("key", "class_id", "n_texts")
    return signatures.select("id", "key").join(named, "key", "left").select("id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_texts", F.lit(1)).alias("n_texts"))
