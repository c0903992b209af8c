"""Secret scans with corpus-wide ownership frequency (operator 3).

One pass over the texts finds candidates: ``assign`` (a key word, then a value),
``access`` (AKIA keys), ``hex`` (32 or more digits) and ``token`` (runs of 16 or
more key characters with a letter and a digit). Each candidate's value is
hashed; hashes are counted by distinct repository (a document) and distinct
owner, first per owner, so that a hash in a third of all rows is added up before
it moves. A value held by ``WIDELY`` or more owners, or in
``WIDELY_REPOSITORIES`` or more repositories, is a widely copied example, one
held in fewer repositories of a single owner and without placeholder look is a
live credential, the rest is shared.

``assign``, ``access`` and ``hex`` matches are base spans and always stay. The
frequencies add ``token`` candidates outside base spans: as ``copy`` if their
value is a non-example secret found by a base pattern anywhere in the corpus,
else as ``live`` if they are owner-specific and look live.

Offsets are code points, end exclusive. Matches are marked by a control
character, the marked text is split at it, and lengths are added up; that
character in a text counts as another one of the same length that no pattern
holds. Defined results: null text is empty; very long texts are scanned whole, by the task that reads them; a null owner is the owner '', a null
id the repository ''; texts without candidates have empty spans. Repeated rows each get
their row and count as one repository if their ids are equal. Other columns are
not read, or passed on by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read_table, sha_hex, stored, unused

# The base patterns. The runs of hex digits and key characters start at a run's first character, so looking behind saves retries only.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{32,}",
    "token": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}",
}
KINDS = ["assign", "access", "hex", "copy", "live"]  # order of spans that start together
BASE = KINDS[:3]
LEAST_VALUE = 8
WIDELY = 10
WIDELY_REPOSITORIES = 100
DISTINCT_CHARS = 8
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your|xxxx|0123456789|abcdef(?:gh|01)"
MARK, STAND_IN = "\x01", "\x02"


def marked_parts(text: Column, pattern: str) -> Column:
    """Text before the first match, the match, text up to the next, ..."""
    return F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """(uid, id, text_hash, owner, found): stored; ``found`` has, for each kind with matches, the part lengths and the matches."""
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(MARK), F.lit(STAND_IN))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                       F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"), text.alias("text"))
    split = rows.select("uid", "id", "text_hash", "owner", *[marked_parts(F.col("text"), p).alias(k) for k, p in PATTERNS.items()])
    found = F.filter(F.array(*[F.struct(
        F.lit(k).alias("kind"),
        F.when(F.size(k) > 1, F.transform(F.col(k), F.char_length)).alias("lengths"),
        F.when(F.size(k) > 1, F.filter(F.col(k), lambda _, i: i % 2 == 1)).alias("matches")) for k in PATTERNS]), lambda x: x["lengths"].isNotNull())
    return stored(split.select("uid", "id", "text_hash", "owner", found.alias("found")), "secrets")


def candidates(scanned: DataFrame) -> DataFrame:
    """(uid, id, owner, kind, start, end, value, hash) of every candidate."""
    kinds = scanned.where(F.size("found") > 0).select("uid", "id", "owner", F.explode("found").alias("f"))
    parts = kinds.select("uid", "id", "owner", "f.kind", F.posexplode("f.lengths").alias("at", "size"), F.col("f.matches").alias("matches"))
    whole = F.when(F.col("at") % 2 == 1, F.get("matches", F.floor(F.col("at") / 2).cast("int")))
    ends = F.sum("size").over(W.partitionBy("uid", "kind").orderBy("at"))
    spans = parts.select("uid", "id", "owner", "kind", "at", "size", whole.alias("match")).withColumn("end", ends).where("match IS NOT NULL")
    value = F.when(F.col("kind") == "assign", F.regexp_extract("match", ASSIGN, 2)).otherwise(F.col("match"))
    held = spans.select("uid", "id", "owner", "kind", (F.col("end") - F.col("size")).alias("start"), "end", value.alias("value"))
    fits = F.when(F.col("kind") == "assign", F.length("value") >= LEAST_VALUE).when(
        F.col("kind") == "token", F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")).otherwise(True)
    return held.where(fits).withColumn("hash", sha_hex(F.col("value")))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories, n_seen, secret): how widely each value is held, and whether a base pattern found it."""
    base = F.max(F.col("kind").isin(BASE))
    repo = found.groupBy("hash", "owner", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("repo")).agg(F.count("*").alias("n"), base.alias("secret"))
    owner = repo.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"), F.max("secret").alias("secret"))
    return owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repositories"), F.sum("n").alias("n_seen"), F.max("secret").alias("secret"))


def classified(found: DataFrame, widely: int = WIDELY, repositories: int = WIDELY_REPOSITORIES) -> DataFrame:
    """Candidates with ``held``: example, live or shared."""
    looks = (F.size(F.array_distinct(F.split("value", ""))) >= DISTINCT_CHARS) & ~F.col("value").rlike(PLACEHOLDER)
    # stored, so that the join has two plain sides and a value in very many documents can be split
    known = found.join(stored(ownership(found), "ownership"), "hash")
    copied = (F.col("n_owners") >= widely) | (F.col("n_repositories") >= repositories)
    return known.withColumn("held", F.when(copied, "example").when((F.col("n_owners") == 1) & looks, "live").otherwise("shared"))


def secret_spans(scanned: DataFrame, widely: int = WIDELY, repositories: int = WIDELY_REPOSITORIES) -> DataFrame:
    """(uid, spans): per document with any, its spans (start, rank, kind, end, held, n_owners, n_repositories) by start, then kind."""
    rated = classified(stored(candidates(scanned), "candidates"), widely, repositories)
    kind = F.when(F.col("kind").isin(BASE), F.col("kind")).when(F.col("secret") & (F.col("held") != "example"), "copy").when(F.col("held") == "live", "live")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    named = rated.withColumn("kind", kind).where("kind IS NOT NULL").withColumn("rank", rank)
    # an added span that overlaps a base span says nothing new
    is_base = F.col("rank") < len(BASE)
    along = W.partitionBy("uid").orderBy("start", "rank")
    reached = F.max(F.when(is_base, F.col("end"))).over(along.rowsBetween(W.unboundedPreceding, 0))
    following = F.min(F.when(is_base, F.col("start"))).over(along.rowsBetween(1, W.unboundedFollowing))
    kept = named.withColumns({"reached": reached, "following": following}).where(
        is_base | ~(F.coalesce(F.col("reached") > F.col("start"), F.lit(False)) | F.coalesce(F.col("following") < F.col("end"), F.lit(False))))
    return kept.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end", "held", "n_owners", "n_repositories"))).alias("spans"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", widely: int = WIDELY,
                 repositories: int = WIDELY_REPOSITORIES) -> DataFrame:
    """(id, text_hash, spans) for every row of ``docs``."""
    scanned = scan(docs, id_col, text_col, owner_col)
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,held:string,n_owners:bigint,n_repositories:bigint>>")
    return scanned.select("uid", "id", "text_hash").join(secret_spans(scanned, widely, repositories), "uid", "left").select("id", "text_hash", F.coalesce("spans", none).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", mask: str = "<secret>") -> DataFrame:
    """``docs`` with every span that is not a widely copied example replaced by ``mask``; overlapping spans by one."""
    spans = scan_secrets(docs, id_col, text_col, owner_col)
    hide = F.filter("spans", lambda s: s["held"] != "example")
    hit_id, hit_hash, hidden = unused(docs.columns, "_hit_id", "_hit_hash", "_hide")
    hits = spans.select(F.col("id").alias(hit_id), F.col("text_hash").alias(hit_hash), hide.alias(hidden)).where(F.size(hidden) > 0).dropDuplicates([hit_id, hit_hash])
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("upto"))
    text = F.col(text_col)

    def step(acc: Column, s: Column) -> Column:
        before = F.when(s["start"] >= acc["upto"], F.concat(text.substr((acc["upto"] + 1).cast("int"), (s["start"] - acc["upto"]).cast("int")), F.lit(mask))).otherwise(F.lit(""))
        return F.struct(F.concat(acc["out"], before).alias("out"), F.greatest(acc["upto"], s["end"]).alias("upto"))

    def done(acc: Column) -> Column:
        return F.concat(acc["out"], text.substr((acc["upto"] + 1).cast("int"), F.char_length(text)))

    joined = docs.join(hits, docs[id_col].eqNullSafe(hits[hit_id]) & (F.xxhash64(docs[text_col]) == hits[hit_hash]), "left")
    masked = F.when(F.col(hidden).isNotNull(), F.aggregate(hidden, start, step, done)).otherwise(text)
    return joined.select(*[masked.alias(c) if c == text_col else docs[c] for c in docs.columns])


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def count(field: str, value: str) -> Column:
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("bigint").alias(f"n_{value}")

    return found.select(F.col("id").alias("doc_id"), *[count("kind", k) for k in BASE], sha_hex(listed(base)).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                        count("held", "example"), count("held", "live"))


def _sql() -> str:
    def either(word: str) -> str:
        return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)

    words = "|".join(either(w) for w in ("password", "passwd", "secret", "token")) + "|" + either("api") + "_?" + either("key")
    patterns = {
        "assign": f"""({words})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        "access": "AKIA[A-Z0-9]{12,}", "hex": "[0-9a-f]{32,}", "token": "[A-Za-z0-9+/_=-]{16,}",
    }
    parts = " UNION ALL ".join(
        f"SELECT uid, doc_id, owner, '{k}' AS found_by, string_split(regexp_replace(x, '({p})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS parts FROM t" for k, p in patterns.items())
    order = "CASE kind " + " ".join(f"WHEN '{k}' THEN {n}" for n, k in enumerate(KINDS)) + " END"
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS uid, doc_id, coalesce(source, '') AS owner, replace(coalesce(text, ''), chr(1), chr(2)) AS x FROM documents
), p AS ({parts}
), e AS (SELECT uid, doc_id, owner, found_by, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM p WHERE len(parts) > 1
), s AS (SELECT *, sum(length(part)) OVER (PARTITION BY uid, found_by ORDER BY i) AS stop FROM e
), m AS (
  SELECT uid, doc_id, owner, found_by, stop - length(part) AS start, stop,
         CASE found_by WHEN 'assign' THEN regexp_extract(part, '{patterns["assign"]}', 2) ELSE part END AS value
  FROM s WHERE i % 2 = 0
), c AS (
  SELECT * FROM m WHERE CASE found_by WHEN 'assign' THEN length(value) >= {LEAST_VALUE}
    WHEN 'token' THEN regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') ELSE true END
), o AS (
  SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT {{'owner': owner, 'repo': coalesce(CAST(doc_id AS VARCHAR), '')}}) AS repos,
         bool_or(found_by <> 'token') AS secret FROM c GROUP BY value
), r AS (
  SELECT c.*, secret, CASE WHEN owners >= {WIDELY} OR repos >= {WIDELY_REPOSITORIES} THEN 'example'
    WHEN owners = 1 AND len(list_distinct(string_split(value, ''))) >= {DISTINCT_CHARS}
         AND NOT regexp_matches(value, '{PLACEHOLDER}') THEN 'live' ELSE 'shared' END AS held
  FROM c JOIN o USING (value)
), k AS (
  SELECT *, CASE WHEN found_by <> 'token' THEN found_by WHEN secret AND held <> 'example' THEN 'copy' WHEN held = 'live' THEN 'live' END AS kind FROM r
), z AS (
  SELECT *, {order} AS n FROM k a WHERE kind IS NOT NULL AND (found_by <> 'token' OR NOT EXISTS (
    SELECT 1 FROM k b WHERE b.uid = a.uid AND b.found_by <> 'token' AND b.start < a.stop AND a.start < b.stop))
), g AS (
  SELECT uid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, n) FILTER (n < {len(BASE)}) AS base,
         string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, n) AS spans,
         count(*) FILTER (held = 'example') AS n_example, count(*) FILTER (held = 'live') AS n_live
  FROM z GROUP BY uid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_example, 0) AS n_example, coalesce(n_live, 0) AS n_live
FROM t LEFT JOIN g USING (uid)
"""


OP3_SQL = _sql()
