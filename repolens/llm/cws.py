"""Document fingerprints by consistent weighted sampling, built-in
functions only.

A document is its words (lower-cased, parted by white space), weighted by
their counts.  Sample k of a term of weight w draws r and c from Gamma(2, 1)
and b from [0, 1) by hashing (term, k), and takes

    t = floor(ln w / r + b),   ln a = ln c - r * (t - b + 1).

The term of least a, with its t, is the document's k-th sample.  Two
documents agree in a sample with probability sum(min weights) / sum(max
weights), their generalised Jaccard similarity; ``likeness`` is the share of
samples that agree.

``fingerprints`` also takes each document's successor in doc_id order and
the fingerprint of an edited text (second half replaced by the head of the
successor's text).  Documents are cut into ranges of doc_id; the first
document of a range is also sent to the range before it, so successors,
term counts and samples are all found inside a range: the texts move once.
The cut points (at most ``MAX_RANGES`` numbers) are the only data that
reaches the driver.

Defined results: a null text is empty; a text without words has the
fingerprint of nothing (all samples at the largest value, equal to that of
other such texts only); a null doc_id comes first; repeated doc_ids are
ordered by a hash of the text and each row is a document; a single document
is its own successor; an empty table gives no rows; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 32
PER_ROW = 8               # samples of one generated row: keeps the generated code small enough to be compiled
ROWS_PER_RANGE, MAX_RANGES = 256, 65_536
NOTHING = (1 << 63) - 1
_FIRST = -(1 << 63)


def samples(k: Column, term: str = "term", ln_w: str = "ln_w") -> list[Column]:
    """The samples k*PER_ROW .. of a term: the high 31 bits grow with ln a,
    the low 32 bits identify (term, t)."""
    out = []
    for j in range(PER_ROW):
        h = f"xxhash64({term}, k * {PER_ROW} + {j})"
        g = f"xxhash64({h}, 7)"
        # uniform numbers in (0, 1) from disjoint bits
        u = [f"(((shiftrightunsigned({x}, {s}) & {m - 1}L) + 0.5D) / {m}D)"
             for x, s, m in ((h, 32, 1 << 32), (h, 0, 1 << 32), (g, 40, 1 << 24), (g, 16, 1 << 24), (g, 0, 1 << 16))]
        r, c = f"(-ln({u[0]} * {u[1]}))", f"(-ln({u[2]} * {u[3]}))"
        t = f"floor({ln_w} / {r} + {u[4]})"
        ln_a = f"(ln({c}) - {r} * ({t} - {u[4]} + 1D))"
        # ln a lies in (-120, 6): 2^31 / 128 steps a unit
        high = f"cast(({ln_a} + 121D) * 16777216D as bigint)"
        out.append(F.expr(f"shiftleft({high}, 32) | (xxhash64({h}, {t}) & 4294967295L)"))
    return out


def likeness(a: Column, b: Column) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.lit(float(SAMPLES))


def word_weights(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, term (hash of a word) and ln_w (of its count)."""
    words = texts.select(*keys, F.explode(F.split(F.lower("text"), r"[ \t\n\x0B\f\r]+")).alias("word"))
    return (words.filter("word <> ''").groupBy(*keys, F.xxhash64("word").alias("term"))
            .agg(F.ln(F.count(F.lit(1)).cast("double")).alias("ln_w")))


def sign(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fingerprint`` (array of SAMPLES longs) of the rows of
    (keys, text) that have words.  ``keys`` must tell rows apart."""
    rows = word_weights(texts, keys).withColumn("k", F.explode(F.array(*map(F.lit, range(SAMPLES // PER_ROW)))))
    least = rows.groupBy(*keys, "k").agg(*[F.min(s).alias(f"m{j}") for j, s in enumerate(samples(F.col("k")))])
    parts = least.select(*keys, F.struct("k", F.array(*[f"m{j}" for j in range(PER_ROW)]).alias("m")).alias("part"))
    return (parts.groupBy(*keys).agg(F.sort_array(F.collect_list("part")).alias("parts"))
            .select(*keys, F.flatten(F.transform("parts", lambda x: x["m"])).alias("fingerprint")))


def range_cuts(ids: DataFrame, rows_per_range: int) -> tuple[list[int], int | None]:
    """Cut points of the column ``ord`` (values that occur), and its least
    value: at most MAX_RANGES numbers, from a sketch of bounded size."""
    n = ids.count()
    ranges = max(1, min(MAX_RANGES, n // rows_per_range))
    shares = ",".join(repr(i / ranges) for i in range(1, ranges)) or "0.5"
    row = ids.agg(F.min("ord").alias("least"), F.expr(
        f"percentile_approx(ord, cast(split('{shares}', ',') as array<double>), {max(10_000, 10 * ranges)})")
        .alias("cuts")).first()
    if row["least"] is None:
        return [], None
    return sorted({c for c in row["cuts"] if c > row["least"]}), row["least"]


def _array(cuts: list[int]) -> Column:
    return F.expr(f"cast(split('{','.join(map(str, cuts))}', ',') as array<bigint>)")


def _with_range(rows: DataFrame, cuts: list[int]) -> DataFrame:
    """``rows`` with the number of cut points up to ``ord``, by binary search
    (a projection a step; lambda variables would keep Spark from reading one
    exchange twice)."""
    rows = rows.withColumn("at", F.lit(0))
    held = _array(cuts) if cuts else None
    for bit in range(len(cuts).bit_length() - 1, -1, -1):
        step = 1 << bit
        reached = F.coalesce(F.get(held, F.col("at") + (step - 1)) <= F.col("ord"), F.lit(False))
        rows = rows.withColumn("at", F.when(reached, F.col("at") + step).otherwise(F.col("at")))
    return rows


def with_next(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(range, row, guest, doc_id, text, next_text): every document and its
    successor's text; a guest is the first document after its range."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    src = src.withColumn("ord", F.coalesce("doc_id", F.lit(_FIRST)))
    cuts, least = range_cuts(src.select("ord"), rows_per_range)
    last = len(cuts)
    # the search below has found the last cut point up to ``ord``
    firsts = F.coalesce(F.get(_array(cuts), F.col("at") - 1) == F.col("ord"), F.lit(False)) if cuts else F.lit(False)

    def place(r: Column, guest: bool) -> Column:
        return F.struct(r.cast("int").alias("range"), F.lit(guest).alias("guest"))

    places = (F.when(F.col("ord") == F.lit(least), F.array(place(F.col("at"), False), place(F.lit(last), True)))
              .when(firsts, F.array(place(F.col("at"), False), place(F.col("at") - 1, True)))
              .otherwise(F.array(place(F.col("at"), False))))
    rows = _with_range(src, cuts).select("doc_id", "text", "ord", F.explode(places).alias("p")).select(
        "p.range", "p.guest", "doc_id", "ord", "text")
    # all columns take part in the order, so that every use of these rows reads one and the same exchange
    order = Window.partitionBy("range").orderBy("guest", "ord", "doc_id", F.xxhash64("text"))
    return rows.select("range", "guest", "doc_id", "text", F.row_number().over(order).alias("row"),
                       F.lead("text").over(order).alias("next_text"))


def fingerprints(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (arrays), near_edited, near_next."""
    rows = with_next(docs, rows_per_range)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"),
                      F.when(half > 0, F.expr("substring(next_text, 1, cast(floor(length(text) / 2) as int))")).otherwise(""))
    known = rows.withColumn("edited", F.when(F.col("guest"), F.lit(None)).otherwise(edited))
    keys = ["range", "row"]
    texts = known.select(*keys, F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("x")).select(*keys, "x.which", "x.text")
    signed = sign(texts, [*keys, "which"]).groupBy(*keys).agg(
        F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("own"),
        F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("other"))
    facts = known.select(*keys, "guest", "doc_id", F.length("text").cast("long").alias("n_chars"),
                         F.sha2("edited", 256).alias("edited_sha256"))
    nothing = F.array_repeat(F.lit(NOTHING), SAMPLES)
    order = Window.partitionBy("range").orderBy("row")
    both = facts.join(signed, keys, "left").withColumns(
        {"own": F.coalesce("own", nothing), "other": F.coalesce("other", nothing)})
    return (both.withColumn("after", F.lead("own").over(order)).filter(~F.col("guest"))
            .select("doc_id", "n_chars", "edited_sha256", F.col("own").alias("fingerprint"),
                    F.col("other").alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"),
                    likeness(F.col("own"), F.col("after")).alias("near_next")))


def as_text(fingerprint: Column) -> Column:
    """16 hex digits a sample, joined."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")
