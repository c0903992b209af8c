"""Document fingerprints by consistent weighted sampling (operator 4).

Terms are the words ``[^\\x20\\x09-\\x0D]+`` of a whole text, weighted by how often
they stand in it. For each sample i and term k, hashes of (k, i) give
r ~ Gamma(2, 1) and c ~ Gamma(2, 1), each -ln of a product of two uniforms, and
b ~ U(0, 1). With weight S:

    t = floor(ln S / r + b),  ln a = ln c - r (t - b + 1)

The sample is the (k, t) of the least a; two texts agree on a sample with the
probability of their generalised Jaccard similarity sum min / sum max. A
fingerprint is ``SAMPLES`` samples of 32 bits in hex; likeness is the share of
equal samples.

All of it is columns and aggregates. Distinct terms are rows, the least a of
each sample is a grouped minimum of one long (a in the high bits, the sample in
the low ones), and every grouping follows the document's bucket, so texts are
shuffled once. Buckets are ranges of the order column cut at its quantiles; each
bucket's first row is also sent to the bucket before, which so holds the next
document of its last row.

Defined results: null text is empty; a text without words has the all-zero
fingerprint, which is like itself only. Very long texts are sampled whole, by
the task that reads them. Equal ids go by text, null ids first.
Repeated rows each get their row. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions, read_table, sha_hex

GROUPS, EACH = 4, 8
SAMPLES = GROUPS * EACH
SEPARATORS = r"[\x20\x09-\x0D]+"
LEAST = -(1 << 63)


def barrier(df: DataFrame, keep: list[str], **made: Column) -> DataFrame:
    """``df`` with columns ``made`` computed once: a generator keeps them from being copied into each later use."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))


def uniform(h: Column, shift: int, bits: int) -> Column:
    return (F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")) + 0.5) / float(1 << bits)


def sample(term: Column, log_weight: Column, i: Column) -> Column:
    """One long: ln a of the term's sample i in fixed point, then 32 bits that stand for (term, t)."""
    x = F.xxhash64(term, i)
    y = F.xxhash64(x, i)
    r = -F.ln(uniform(x, 0, 21) * uniform(x, 21, 21))
    b = uniform(x, 42, 21)
    t = F.floor(log_weight / r + b)
    log_a = F.ln(-F.ln(uniform(y, 0, 31) * uniform(y, 31, 31))) - r * (t - b + 1)
    order = ((log_a + 128) * float(1 << 23)).cast("bigint")
    return F.shiftleft(order, 32).bitwiseOR(F.xxhash64(x, t).bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")))


def terms(texts: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """``keep`` columns with (term, tf): hash and count of each distinct word."""
    words = F.array_remove(F.split(F.col(text_col), SEPARATORS), "")
    hashed = barrier(texts, keep, h=F.sort_array(F.transform(words, lambda w: F.xxhash64(w))))
    n = F.size("h")
    firsts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("h", i) != F.get("h", i - 1)))
    cut = barrier(hashed.where(n > 0), [*keep, "h"], at=firsts)
    runs = F.transform("at", lambda s, k: F.struct(F.get("h", s).alias("term"), (F.coalesce(F.get("at", k + 1), F.size("h")) - s).alias("tf")))
    return cut.select(*keep, F.inline(runs))


def signatures(texts: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """``keep`` columns with ``samples``: array of SAMPLES numbers under 2 ** 32. Texts without words have no row."""
    each = terms(texts, keep, text_col).select(*keep, "term", F.ln(F.col("tf").cast("double")).alias("log_weight"), F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))).alias("g"))
    least = each.groupBy(*keep, "g").agg(*[F.min(sample(F.col("term"), F.col("log_weight"), F.col("g") * EACH + k)).alias(f"m{k}") for k in range(EACH)])
    low = F.array(*[F.col(f"m{k}").bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")) for k in range(EACH)])
    return least.groupBy(*keep).agg(F.sort_array(F.collect_list(F.struct("g", low.alias("low")))).alias("parts")).select(*keep, F.flatten("parts.low").alias("samples"))


def likeness(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / float(SAMPLES)


def as_text(samples: Column) -> Column:
    return F.lower(F.array_join(F.transform(samples, lambda s: F.lpad(F.hex(s), 8, "0")), ""))


def bucket_of(c: Column, bounds: list[int], base: int = 0) -> Column:
    """How many of the sorted ``bounds`` are at most ``c``, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(base)
    m = len(bounds) // 2
    return F.when(c < F.lit(bounds[m]), bucket_of(c, bounds[:m], base)).otherwise(bucket_of(c, bounds[m + 1:], base + m + 1))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, place, spare, id, text, next): every text with the one that follows by ascending id, after the last the first.

    ``spare`` rows are the next bucket's first row, there for their text only.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(LEAST)).alias("order"))
    wanted = 4 * partitions(spark)
    cuts = rows.agg(F.percentile_approx("order", [k / wanted for k in range(1, wanted)], 20 * wanted)).first()[0] or []
    bucket = bucket_of(F.col("order"), sorted(set(cuts)))
    placed = rows.withColumn("bucket", bucket)
    firsts = placed.groupBy("bucket").agg(F.min("order").alias("first")).orderBy("bucket").collect()  # at most ``wanted`` rows
    before = [(r["bucket"], r["first"], firsts[k - 1]["bucket"]) for k, r in enumerate(firsts)]
    heads = spark.createDataFrame(before, "bucket int, first bigint, earlier int")
    sent = placed.join(F.broadcast(heads), "bucket").select("id", "text", "order", F.explode(F.filter(F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("spare")),
        F.when(F.col("order") == F.col("first"), F.struct(F.col("earlier").alias("bucket"), F.lit(1).alias("spare")))), lambda x: x.isNotNull())).alias("to"))
    # ordering by the id and the filter change nothing, but every use of this frame then has the same plan and shares one exchange
    along = W.partitionBy("bucket").orderBy("spare", "order", "id", "text")
    return sent.select("to.bucket", "to.spare", "id", "text", "order").where("bucket IS NOT NULL").select(
        "bucket", F.row_number().over(along).alias("place"), "spare", "id", "text", F.lead("text").over(along).alias("next"))


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last floor(n / 2) code points replaced by as many of the next text's first ones, or all of them."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(text.substr(F.lit(1), n - half), following.substr(F.lit(1), half))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = with_next(read_table(spark, sf_dir, "documents"))
    changed = F.when(F.col("spare") == 0, edited(F.col("text"), F.coalesce("next", F.lit(""))))
    facts = frame.select("bucket", "place", "spare", "id", F.char_length("text").cast("bigint").alias("n_chars"), sha_hex(changed).alias("edited_sha256"))
    sides = frame.select("bucket", "place", F.posexplode(F.array("text", changed)).alias("side", "body")).where("body IS NOT NULL")
    found = signatures(sides, ["bucket", "place", "side"], "body")
    both = found.groupBy("bucket", "place").agg(*[F.max(F.when(F.col("side") == k, F.col("samples"))).alias(f"s{k}") for k in (0, 1)])
    none = F.array_repeat(F.lit(0).cast("bigint"), SAMPLES)
    full = facts.join(both, ["bucket", "place"], "left").withColumns({"s0": F.coalesce("s0", none), "s1": F.coalesce("s1", none)})
    ahead = full.withColumn("following", F.lead("s0").over(W.partitionBy("bucket").orderBy("place")))
    return ahead.where("spare = 0").select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", as_text(F.col("s0")).alias("fingerprint"), as_text(F.col("s1")).alias("edited_fingerprint"),
        likeness(F.col("s0"), F.col("s1")).alias("near_edited"), likeness(F.col("s0"), F.col("following")).alias("near_next"))
