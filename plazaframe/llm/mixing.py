"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame expressions only.

A document's size is its number of words. Sources, in the order of their code points and null last, weigh ``WEIGHTS`` in turn, and share
``PERCENT`` of all words by weight. No source takes more than ``LIMIT`` times its own words: what lies above is shared again by weight among the others
until none is above. Target over size is a source's rate; each of its documents is copied floor(rate) times, and once more with
the probability that is left.

These probabilities are rounded in pairs. Of two documents of a source one gives, at random, as many expected words to the other
as either can give or take until one probability is 0 or 1; that one is decided, and the other goes on with what is left. The direction is
drawn so that every probability is kept on average, and the expected words of the source are kept exactly. Pairs are made in
groups of about ``FAN`` documents, from the largest to the smallest; what a group leaves undecided, one document, is combined
with that of other groups in a tree of as many levels as the logarithm of the documents to ``FAN``. One document per source
is undecided in the end: it goes to the nearer side, so that a source misses its target by half of one document at most.

No task sees more than one group, of whatever source: documents are dealt to groups by a hash. Rows that agree in id, source and size are interchangeable and are
one entry with a number of copies, of which at most one is fractional. All draws are hashes of ids, sources, sizes and ``seed``:
reruns agree, whatever the partitions.

Null texts and texts without words have size 0 and take 0; so does a source without words, whose target is 0. Null sources are one source, null
ids are ids of their own. Repeated rows are mixed each for itself. An empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaframe.llm.arrays import let
from plazaframe.operators.durable import materialise
from plazaframe.operators.sequence import cut_in_order, total_before
from plazaframe.operators.skew import HOT_ROWS, attach

WEIGHTS = (5, 2, 1)
PERCENT = 150
LIMIT = 2
#: Undecided documents that one group combines.
FAN = 64
#: Interchangeable rows that one task writes out.
CHUNK = 100_000
_UNIT = ["size", "draw", "id", "copies", "base", "whole", "p"]


def words(text: Column) -> Column:
    """How many runs of characters other than white space a text has; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, limit: int = LIMIT) -> DataFrame:
    """``sources`` (source, source_size) with the words each is to give: target, a double."""
    ordered = [F.col("source").asc_nulls_last()]
    n = sources.count()
    numbered = total_before(cut_in_order(sources.withColumn("one", F.lit(1)), [], ordered, 1 + n // HOT_ROWS), [], ordered, "one")
    place = (F.col("_before") % len(weights)).cast("int")
    weighed = materialise(numbered.select("source", "source_size", F.get(F.array(*map(F.lit, weights)), place).alias("weight")))
    wide = "decimal(38,0)"
    total, weight = (int(x or 0) for x in weighed.agg(F.sum(F.col("source_size").cast(wide)), F.sum(F.col("weight").cast(wide))).first())
    left, share, full = percent * total, weight, -1
    while True:  # ``left`` hundredths of words for ``share`` weights; each round finds the sources that this fills
        above = F.col("weight").cast(wide) * F.lit(left).cast(wide) > F.col("source_size").cast(wide) * F.lit(100 * limit * share).cast(wide)
        found = weighed.where(above).agg(F.count("*"), F.sum(F.col("source_size").cast(wide)), F.sum(F.col("weight").cast(wide))).first()
        if found[0] == full or share == 0:
            break
        full, left, share = found[0], percent * total - 100 * limit * int(found[1] or 0), weight - int(found[2] or 0)
    target = (F.col("source_size") * limit).cast("double")
    for w in set(weights) if share else ():
        target = F.when((F.col("weight") == w) & ~above, F.lit(float(Fraction(w * left, 100 * share)))).otherwise(target)
    return materialise(weighed.select("source", "source_size", target.alias("target")))


def _uniform(number: Column) -> Column:
    """A number from 0 to below 1 for a hash."""
    return F.pmod(number, F.lit(1 << 53)) / F.lit(float(1 << 53))


def pivot(units: Column) -> Column:
    """``decided`` (units with ``won``) and ``rest``, the undecided one, of an array of units, paired in order."""

    def pair(state: Column, unit: Column) -> Column:
        rest = state["rest"]
        a, p, b, q = rest["size"], rest["p"], unit["size"], unit["p"]
        to_rest, to_unit = F.least((1 - p) * a, q * b), F.least(p * a, (1 - q) * b)

        def settle(up: Column) -> Column:
            leaves = F.when(up, (1 - p) * a <= q * b).otherwise(p * a <= (1 - q) * b)  # the document carried so far is the one decided
            moved = F.when(up, to_rest).otherwise(-to_unit)

            def state_after(gone: Column) -> Column:
                decided = F.when(gone, rest).otherwise(unit)
                goes_on = F.when(gone, unit.withField("p", _probability(q - moved / b))).otherwise(rest.withField("p", _probability(p + moved / a)))
                won = (up == gone).cast("int")
                return F.struct(F.concat(state["decided"], F.array(decided.withField("won", won))).alias("decided"), goes_on.alias("rest"))

            return let(leaves, state_after)

        return let(_uniform(F.xxhash64(rest["draw"], unit["draw"])) * (to_rest + to_unit) < to_unit, settle)

    first = F.get(units, 0)
    none = F.slice(F.array(first.withField("won", F.lit(0))), 1, 0)
    return F.aggregate(F.slice(units, 2, F.size(units)), F.struct(none.alias("decided"), first.alias("rest")), pair)


def _probability(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def _round(units: DataFrame, fan: int) -> DataFrame:
    """All ``units`` with ``won``, 0 or 1."""
    counts = materialise(units.groupBy("source").agg(F.count("*").alias("open")))
    most = counts.agg(F.max("open")).first()[0] or 0
    now, out, level = attach(units, counts, ["source"]), [], 0
    while most > 1:
        level += 1
        most = -(-most // fan)
        groups = F.ceil(F.col("open") / fan).cast("long")
        dealt = now.select("source", groups.alias("open"), F.pmod(F.xxhash64("draw", F.lit(level)), groups).alias("group"), F.struct(*_UNIT).alias("unit"))
        listed = dealt.groupBy("source", "open", "group").agg(F.sort_array(F.collect_list("unit"), asc=False).alias("units"))
        done = materialise(listed.select("source", "open", pivot(F.col("units")).alias("done")))
        out.append(done.select("source", F.explode("done.decided").alias("unit")).select("source", "unit.*"))
        now = done.select("source", "open", "done.rest.*")
    out.append(now.drop("open").withColumn("won", (F.col("p") >= 0.5).cast("int")))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def _rows(decided: DataFrame, most: int) -> DataFrame:
    """One row per document again: interchangeable rows differ only in how often they are taken."""
    extra = F.col("whole") + F.col("won")
    kinds = F.array(F.struct(extra.alias("n"), (F.col("base") + 1).alias("times")), F.struct((F.col("copies") - extra).alias("n"), F.col("base").alias("times")))
    kinds = decided.select("source", "id", "size", F.explode(F.filter(kinds, lambda k: k["n"] > 0)).alias("k")).select("source", "id", "size", "k.*")
    if most > 1:
        last = F.floor((F.col("n") - 1) / CHUNK).cast("long")
        kinds = kinds.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        if most > CHUNK:
            kinds = kinds.repartition(4 * int(kinds.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        each = F.array_repeat(F.lit(1), F.least(F.lit(CHUNK), F.col("n") - F.col("chunk") * CHUNK).cast("int"))
        kinds = kinds.withColumn("one", F.explode(each))
    return kinds.select("source", "id", "size", "times")


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    percent: int = PERCENT,
    limit: int = LIMIT,
    fan: int = FAN,
    seed: int = 0,
) -> DataFrame:
    """Per document id, source, size, the source's source_size and target, times (how often the mix takes it) and taken, in words."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"))
    entries = materialise(slim.groupBy("source", "id", "size").agg(F.count("*").alias("copies")))
    sources = targets(entries.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")), weights, percent, limit)
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = attach(entries, sources, ["source"]).select("source", "id", "size", "copies", rate.alias("rate"))
    rated = rated.withColumn("base", F.floor("rate").cast("long")).withColumn("p", F.col("copies") * (F.col("rate") - F.col("base")))
    whole = F.least(F.floor("p"), F.col("copies")).cast("long")
    draw = F.xxhash64(F.lit(seed), "source", "id", F.col("id").isNull(), F.col("source").isNull(), "size")
    units = materialise(rated.select("source", *(c for c in _UNIT if c not in ("draw", "whole", "p")), draw.alias("draw"), whole.alias("whole"), (F.col("p") - whole).alias("p")))
    decided = _round(units.where("p > 0"), fan).select("source", *_UNIT, "won")
    decided = decided.union(units.where("p = 0").select("source", *_UNIT, F.lit(0).alias("won")))
    most = entries.agg(F.max("copies")).first()[0] or 0
    mixed = attach(_rows(decided, most), sources, ["source"])
    return mixed.select("id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))
