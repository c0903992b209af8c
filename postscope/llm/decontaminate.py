"""Benchmark decontamination by a positional inverted index (operator 5).

Words: A-Z lower-cased, then runs outside ``\\x00-\\x2F \\x3A-\\x60 \\x7B-\\x7F``.

1. ``forward`` stores the words of every document once, in order.
2. The index holds a posting (term, document, position) with the words around it
   for the terms that phrases are looked up by: of each ``window`` of consecutive
   test words, the rarest by corpus count. Other terms' lists would never be
   read, so they are not written.
3. A lookup starts from the rarest term of each window, intersects with the
   second rarest one's words at its offset, and compares the remaining words
   outwards; only an unbroken run of ``window`` equal words is an exact match.
   A run of that length around a posting covers every matching window that
   holds the posting, and every window is looked up by its own rarest term, so
   nothing is missed. ``proximity_matches`` looks for all terms of a window within
   ``slop`` words of its rarest one, in any order, for ``near_items`` of ``contamination``.

The test side is broadcast only while its terms are counted to be at most
``BROADCAST_TERMS`` and its lookups ``BROADCAST_LOOKUPS``; beyond that the same joins shuffle.

Defined results: null text has no words; an item without words has no window, a
shorter item than the window is one window. Very long texts are indexed whole. A null item id counts as the id
''. Repeated documents each get their row, repeated items count once by id. An
empty documents table gives an empty result, an empty benchmark no hits. Other
columns of either input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_az, read_table, sha_hex, stored

WINDOW = 13
SLOP = 16
BROADCAST_TERMS, BROADCAST_LOOKUPS = 500_000, 50_000  # rows: about 20 MB and 30 MB
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(c: Column) -> Column:
    return F.array_remove(F.split(lower_az(F.coalesce(c, F.lit(""))), SEPARATORS), "")


def small(df: DataFrame, rows: int, most: int | None = None) -> DataFrame:
    """A broadcast side while its counted rows are at most ``most`` (default: ``BROADCAST_TERMS``)."""
    return F.broadcast(df) if rows <= (BROADCAST_TERMS if most is None else most) else df


def forward(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, id, text_hash, words), stored; ``uid`` numbers the rows."""
    return stored(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                              words(F.col(text_col)).alias("words")), "forward")


def around(width: int) -> tuple[Column, Column]:
    """Up to ``width`` words before position ``pos`` of ``words``, nearest first, and after it."""
    pos = F.col("pos")
    return (F.reverse(F.slice("words", F.greatest(pos - (width - 1), F.lit(1)), F.least(pos, F.lit(width)))).alias("before"),
            F.slice("words", pos + 2, width).alias("after"))


def equal_run(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    n = F.least(F.size(a), F.size(b))
    odd = F.array_position(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y), False)
    return F.when(odd == 0, n).otherwise(odd - 1).cast("int")


def items_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("words"))
    return stored(items.where(F.size("words") > 0).withColumn("item_uid", F.monotonically_increasing_id()), "items")


def term_counts(index: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """Corpus count of every term of ``terms`` that occurs."""
    seen = index.select(F.explode("words").alias("term"))
    return seen.join(small(terms, n_terms), "term", "left_semi").groupBy("term").count()


def lookups(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """One row for each rarest position of some window, with the offset and word of that window's second rarest one.

    Windows that hold a term the corpus lacks cannot occur and are left out.
    """
    spots = items.select("item_uid", F.posexplode("words").alias("pos", "term")).join(counts, "term", "left")
    ranked = spots.groupBy("item_uid").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("count", F.lit(0)).alias("count"), "term"))).alias("spots"))
    wide = items.join(ranked, "item_uid").withColumn("length", F.least(F.size("words"), F.lit(window)))
    cut = wide.withColumn("start", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))))
    rare = F.sort_array(F.transform(F.slice("spots", F.col("start") + 1, F.col("length")), lambda s: F.struct(s["count"].alias("count"), s["pos"].alias("pos"), s["term"].alias("term"))))
    best = cut.withColumn("rare", F.slice(rare, 1, 2)).where(F.col("rare")[0]["count"] > 0)
    chosen = best.select("item", "length", "words", F.col("rare")[0]["pos"].alias("pos"), F.col("rare")[0]["term"].alias("term"), F.element_at("rare", -1).alias("next"))
    return chosen.select("item", "length", "pos", "term", (F.col("next.pos") - F.col("pos")).alias("offset"), F.col("next.term").alias("partner"), *around(window - 1)).distinct()


def postings(index: DataFrame, terms: DataFrame, n_terms: int, width: int) -> DataFrame:
    """(term, uid, pos, before, after): where each of ``terms`` stands, with ``width`` words on either side; stored."""
    spots = index.select("uid", "words", F.posexplode("words").alias("pos", "term"))
    return stored(spots.join(small(terms, n_terms), "term", "left_semi").select("term", "uid", "pos", *around(width)), "postings")


class Searches:
    """What exact and proximity search share: the items, their terms with corpus counts, and one posting table of the terms that either looks up."""

    def __init__(self, index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int | None = SLOP):
        self.index, self.items, self.window, self.slop = index, items, window, slop
        terms = stored(items.select(F.explode("words").alias("term")).distinct(), "terms")
        self.n_terms = terms.count()
        self.counts = stored(term_counts(index, terms, self.n_terms), "term-counts")
        self.exact = stored(lookups(items, self.counts, window), "lookups")
        wanted = self.exact.select("term")
        if slop is not None:
            self.near = stored(near_lookups(items, self.counts, window), "near-lookups")
            wanted = wanted.union(self.near.select("term"))
        self.postings = postings(index, wanted.distinct(), self.n_terms, max(window - 1, slop or 0))

    def phrase_matches(self) -> DataFrame:
        """(uid, item, first, last): runs of document words that whole windows of an item cover."""
        q = self.exact.select("term", "item", "length", "offset", "partner", F.col("before").alias("q_before"), F.col("after").alias("q_after"))
        here = F.when(F.col("offset") > 0, F.get("after", F.col("offset") - 1)).when(F.col("offset") < 0, F.get("before", -F.col("offset") - 1)).otherwise(F.col("partner"))
        both = self.postings.join(small(q, self.exact.count(), BROADCAST_LOOKUPS), "term").where(here == F.col("partner"))
        runs = both.select("uid", "item", "pos", "length", equal_run(F.col("before"), F.col("q_before")).alias("left"), equal_run(F.col("after"), F.col("q_after")).alias("right"))
        return runs.where("left + right + 1 >= length").select("uid", "item", (F.col("pos") - F.col("left")).alias("first"), (F.col("pos") + F.col("right")).alias("last"))

    def proximity_matches(self) -> DataFrame:
        """(uid, item): documents that hold every word of some window of an item within ``slop`` words of its rarest one, in any order."""
        near = F.concat(F.array("term"), F.slice("before", 1, self.slop), F.slice("after", 1, self.slop))
        both = self.postings.join(small(self.near, self.near.count(), BROADCAST_LOOKUPS), "term")
        return both.where(F.size(F.array_except("all", near)) == 0).select("uid", "item").distinct()


def near_lookups(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """(item, all, term): the distinct words of each window and the rarest of them; windows that hold a term the corpus lacks are left out."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    cut = items.select("item", "words", F.explode(starts).alias("start"))
    wide = cut.select("item", F.array_sort(F.array_distinct(F.slice("words", F.col("start") + 1, window))).alias("all")).distinct()
    rarest = wide.select("item", "all", F.explode("all").alias("term")).join(counts, "term", "left").groupBy("item", "all").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "term")).alias("least"))
    return rarest.where("least.count > 0").select("item", "all", F.col("least.term").alias("term"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, slop: int | None = SLOP) -> DataFrame:
    """Per document row: id, text_hash, n_words, n_hit, items (sorted ids), contaminated; near_items (sorted ids) unless ``slop`` is None."""
    index = forward(docs, id_col, text_col)
    search = Searches(index, items_of(benchmark), window, slop)
    runs = stored(search.phrase_matches(), "runs")
    hit = runs.select("uid", F.explode(F.sequence("first", "last")).alias("pos")).distinct().groupBy("uid").agg(F.count("*").alias("n_hit"))
    which = runs.select("uid", "item").distinct().groupBy("uid").agg(F.sort_array(F.collect_list("item")).alias("items"))
    rows = index.select("uid", "id", "text_hash", F.size("words").cast("bigint").alias("n_words"))
    full = rows.join(hit.join(which, "uid"), "uid", "left").withColumns({
        "n_hit": F.coalesce("n_hit", F.lit(0).cast("bigint")), "items": F.coalesce("items", F.array().cast("array<string>"))})
    exact = full.select("uid", "id", "text_hash", "n_words", "n_hit", "items", ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
    if slop is None:
        return exact.drop("uid")
    near = search.proximity_matches().groupBy("uid").agg(F.sort_array(F.collect_set("item")).alias("near_items"))
    return exact.join(near, "uid", "left").withColumn("near_items", F.coalesce("near_items", F.array().cast("array<string>"))).drop("uid")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns. Contaminated is a share of words in exact windows,
    so items that are only near decide nothing here and are not searched for."""
    bad = contamination(docs, benchmark, id_col, text_col, slop=None).where("contaminated").select(F.col("id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs[text_col]) == bad["bad_hash"]), "left_anti")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), sha_hex(F.array_join("items", ",")).alias("items_sha256"), "contaminated",
                        F.size("near_items").cast("bigint").alias("n_near_items"), sha_hex(F.array_join("near_items", ",")).alias("near_items_sha256"))


OP5_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS uid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), spans AS (
  SELECT item, w, least(len(w), {WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS s FROM b WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS gram FROM spans
), lengths AS (SELECT DISTINCT n FROM win), places AS (
  SELECT uid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lengths WHERE len(w) >= n
), grams AS (
  SELECT uid, n, s, array_to_string(w[s:s + n - 1], ' ') AS gram FROM places
), m AS (SELECT uid, item, s, n FROM grams JOIN win USING (n, gram)),
h AS (SELECT uid, count(DISTINCT p) AS n_hit FROM (SELECT uid, unnest(range(s, s + n)) AS p FROM m) GROUP BY uid),
i AS (SELECT uid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT uid, item FROM m) GROUP BY uid),
c AS (SELECT term, count(*) AS n FROM (SELECT unnest(w) AS term FROM d) GROUP BY term),
nw AS (SELECT DISTINCT item, list_sort(list_distinct(w[s:s + {WINDOW} - 1])) AS every FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS s FROM b WHERE len(w) > 0)),
rare AS (SELECT item, every, min({{'n': coalesce(c.n, 0), 'term': x.term}}) AS r FROM (SELECT item, every, unnest(every) AS term FROM nw) x LEFT JOIN c USING (term) GROUP BY item, every),
asked AS (SELECT item, every, r.term AS term FROM rare WHERE r.n > 0),
held AS (SELECT uid, w, p, w[p] AS term FROM (SELECT uid, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
near AS (SELECT DISTINCT uid, item FROM held JOIN asked USING (term) WHERE list_has_all(w[greatest(1, p - {SLOP}):p + {SLOP}], every)),
ni AS (SELECT uid, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near_items FROM near GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items, sha256(coalesce(near_items, '')) AS near_items_sha256
FROM d LEFT JOIN h USING (uid) LEFT JOIN i USING (uid) LEFT JOIN ni USING (uid)
"""
