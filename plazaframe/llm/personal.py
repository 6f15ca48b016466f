"""Information-theoretic sanitisation of personal data, in DataFrame expressions only.

Patterns find the protected entities: e-mail addresses, IPv4 addresses, payment cards, phone
numbers. Then the corpus tells which other terms give an entity away. The contexts are the
lines. With N lines, n(e) of them with entity e, n(t) with term t and
n(e, t) with both, PMI(e; t) = log(N n(e, t) / (n(e) n(t))) is how much of e's information
IC(e) = log(N / n(e)) the term reveals. Where PMI >= threshold * IC and at least ``support`` different lines
hold both (copies of a line prove nothing), the term is generalised wherever it stands in a line with that entity.

Matches never cross a line break. To find them without recursion in the pattern engine, separators
inside a number or a domain are first replaced by a mark of the same length. Offsets count code points, ends are exclusive.

Null texts count as empty: no spans. Rows with the same id are told apart by their texts, and equal
rows get equal spans. An empty table gives no rows. Columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaframe.llm.arrays import let, prefix_sums
from plazaframe.operators.durable import materialise

KINDS = ["email", "ip", "card", "phone"]
THRESHOLD = 0.8
SUPPORT = 3
MARK, OTHER = "\x01", "\x02"


def _spans(text: Column, pattern: str) -> Column:
    """start, end and value of the leftmost non-overlapping matches."""

    def place(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        ends = prefix_sums(F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda gap, match: F.length(gap) + F.length(match)))
        return F.zip_with(ends, found, lambda end, match: F.struct((end - F.length(match)).alias("start"), end.alias("end"), match.alias("value")))

    return let(F.regexp_extract_all(text, F.lit(pattern), 0), place)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn test: every second one from the right counts double, as the sum of its digits."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    weighed = F.transform(F.filter(values, lambda d: d.isNotNull()), lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(weighed, F.lit(0), lambda a, b: a + b) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """For each kind an array of (start, end, value)."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    plain = F.translate(text, MARK, OTHER)
    local, part = "A-Za-z0-9._%+-", "A-Za-z0-9-"
    dotted = F.regexp_replace(plain, rf"(?<=[{part}])\.(?=[{part}])", MARK)
    joined = F.regexp_replace(plain, "(?<=[0-9])[ -](?=[0-9])", MARK)
    email = _spans(dotted, rf"(?:\G|(?<![{MARK}{local}]))[{MARK}{local}]++@[{part}]++{MARK}[{MARK}{part}]++")
    ip = _spans(plain, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
    card = _spans(joined, f"[0-9][0-9{MARK}]++")
    phone = _spans(plain, r"\+[0-9][ ().0-9-]+[0-9]")
    octet = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    long_enough = lambda s, low, high: F.length(_digits(s["value"])).between(low, high)
    found = {
        "email": F.when(F.contains(text, F.lit("@")), email),
        "ip": F.when(text.rlike(r"[0-9]\.[0-9]"), F.filter(ip, lambda s: s["value"].rlike(rf"^{octet}\.{octet}\.{octet}\.{octet}$"))),
        "card": F.when(
            text.rlike("[0-9][ -]?[0-9]"), F.filter(card, lambda s: F.when(long_enough(s, 16, 19), _luhn(_digits(s["value"]))).otherwise(F.lit(False)))
        ),
        "phone": F.when(F.contains(text, F.lit("+")), F.filter(phone, lambda s: long_enough(s, 8, 15))),
    }
    return {kind: F.coalesce(found[kind], none) for kind in KINDS}


def find_base(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, text, its hash, an array of spans for each kind, and the ``carried`` columns in a struct."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.struct(F.lit(0).alias("none"), *carry).alias("carried"))
    found = base_spans(F.col("text"))
    return slim.select("doc_id", F.xxhash64("text").alias("text_hash"), "text", *(found[kind].alias(kind) for kind in KINDS), "carried")


def _written(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def _terms(line: Column, at: Column) -> Column:
    """The words of a line, without edges that are no letters, in lower case, with their offsets."""

    def place(found: Column) -> Column:
        gaps = F.split(line, r"\p{L}+(?:['’-]\p{L}+)?+", -1)
        ends = prefix_sums(F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda gap, word: F.length(gap) + F.length(word)))
        return F.zip_with(ends, found, lambda end, word: F.struct((at + end - F.length(word)).alias("start"), (at + end).alias("end"), F.lower(word).alias("term")))

    return let(F.regexp_extract_all(line, F.lit(r"\p{L}+(?:['’-]\p{L}+)?+"), 0), place)


def _lines(text: Column) -> Column:
    """The lines of a text with the offsets at which they begin."""
    lines = F.split(text, "\n", -1)
    return let(lines, lambda ls: F.zip_with(ls, prefix_sums(F.transform(ls, lambda x: F.length(x) + 1)), lambda x, end: F.struct(x.alias("line"), (end - F.length(x) - 1).alias("at"))))


def disclosing_terms(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """doc_id, text_hash and the spans of the terms that give away an entity in their line."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = slim.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(_lines(F.col("text"))).alias("l")).select("doc_id", "text_hash", "l.line", "l.at")
    hints = F.contains(F.col("line"), F.lit("@")) | F.col("line").rlike("[0-9][ .()-]*[0-9]")
    found = base_spans(F.col("line"))
    near = lines.where(hints).select("doc_id", "text_hash", "line", "at", F.concat(*(found[kind] for kind in KINDS)).alias("entities"))
    near = near.where(F.size("entities") > 0).select("doc_id", "text_hash", F.xxhash64("line").alias("line_hash"), "entities", _terms(F.col("line"), F.col("at")).alias("terms"), "at")
    # words inside an entity are not terms of their own
    outside = F.filter("terms", lambda t: ~F.exists("entities", lambda e: (t["start"] < F.col("at") + e["end"]) & (t["end"] > F.col("at") + e["start"])))
    near = materialise(near.select("doc_id", "text_hash", "line_hash", F.array_distinct(F.transform("entities", lambda e: F.xxhash64(e["value"]))).alias("values"), outside.alias("outside")))

    pairs = near.select("line_hash", F.explode("values").alias("entity"), F.array_distinct(F.transform("outside", lambda t: t["term"])).alias("terms"))
    pairs = pairs.select("line_hash", "entity", F.explode("terms").alias("term"))
    both = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.count_distinct("line_hash").alias("lines"))
    both = materialise(both.where(F.col("lines") >= support).select("entity", "term", "n_both"))
    entities = near.select(F.explode("values").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    # of the other terms nothing leaves a task, and of these only their counts
    sought = materialise(both.select("term").distinct())
    everywhere = lines.select(F.explode(F.array_distinct(F.transform(_terms(F.col("line"), F.lit(0)), lambda t: t["term"]))).alias("term"))
    held = everywhere.join(sought, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_term"))
    n = lines.count()
    ratio = 1 - F.log(F.col("n_term") / F.col("n_both")) / F.log(F.lit(float(n)) / F.col("n_entity"))
    disclosing = both.join(entities, "entity").join(held, "term").where((F.col("n_entity") < n) & (ratio >= threshold)).select("entity", "term")
    placed = near.select("doc_id", "text_hash", F.explode("values").alias("entity"), "outside").select("doc_id", "text_hash", "entity", F.explode("outside").alias("t"))
    placed = placed.select("doc_id", "text_hash", "entity", "t.term", "t.start", "t.end").join(disclosing, ["entity", "term"])
    spans = F.sort_array(F.collect_set(F.struct("start", "end")))
    return placed.groupBy("doc_id", "text_hash").agg(spans.alias("terms"))


def find_personal(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, support: int = SUPPORT, carry: Sequence[str] = ()) -> DataFrame:
    """Per document its text, the spans of each kind, those of disclosing terms (``terms``), and the ``carried`` columns in a struct."""
    base = find_base(docs, id_col=id_col, text_col=text_col, carry=carry)
    extra = disclosing_terms(docs, id_col=id_col, text_col=text_col, threshold=threshold, support=support)
    extra = extra.select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), "terms")
    same = base["doc_id"].eqNullSafe(extra["of_doc"]) & (base["text_hash"] == extra["of_text"])
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return base.join(extra, same, "left").select("doc_id", "text", *KINDS, F.coalesce("terms", none).alias("terms"), "carried")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans in writing."""
    written = {kind: _written(kind, F.col(kind)) for kind in KINDS}
    base = F.array_join(F.concat(*written.values()), ",")
    every = F.array_join(F.concat(*written.values(), _written("term", F.col("terms"))), ",")
    return found.select("doc_id", *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS), F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))


def _labelled(spans: str, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"<{kind.upper()}>").alias("label")))


def sanitised(found: DataFrame) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first names the place."""
    labelled = F.concat(*(_labelled(kind, kind) for kind in KINDS), _labelled("terms", "term"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    text = F.col("text")

    def step(done: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, done["at"].cast("int") + 1, (s["start"] - done["at"]).cast("int")), s["label"])
        fresh = s["start"] >= done["at"]
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(fresh, F.concat(done["out"], F.array(piece))).otherwise(done["out"]).alias("out"))

    finish = lambda done: F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"].cast("int") + 1, F.length(text)))
    return let(F.sort_array(labelled), lambda all_spans: F.when(F.size(all_spans) == 0, text).otherwise(F.aggregate(all_spans, zero, step, finish)))
