"""Personal data and information-theoretic sanitisation (operator 10).

Base spans: ``email``, ``ip``, ``card`` and ``phone`` matches of whole texts. Their
values are the protected entities.

A term says something about an entity when the two come together more often
than apart. The unit of co-occurrence is the whole line. Over all lines of the corpus:

    IC(e)     = -log p(e)
    PMI(e; t) = log p(e, t) / (p(e) p(t))

A term on a line of the entity, outside base spans, discloses it if PMI(e; t) >= IC(e) / alpha
with ``alpha`` = ``DISCLOSE``; alpha 1 would mean that the term gives the entity
away completely. Copies of a line are one text, and one text is no repeated
evidence: of the m distinct line texts of e, k >= ``SUPPORT`` hold t, and that many
must be unlikely by chance, by the bound exp(-m KL(k/m, p(t))) <= ``CHANCE``. Every
occurrence of a disclosing term on a line of its entity is an added span: at or
above IC(e) / ``REMOVE`` it is removed (``term``), below that
generalised to its kind (``general``): digits to <number>, capitalised words to
<name>, others to <word>.

One pass over the texts finds entities and keeps their lines; a second counts
the candidate words once per line, added up per task before they move. Only entities
with enough distinct lines are paired, each distinct line once, and pairs are added up
per task, so a value in a third of all lines is pre-aggregated.

Defined results: null text is empty; a text without matches has empty spans; very
long texts are scanned whole, line by line; a null id is an id. Base spans of different kinds may overlap; added spans never
touch a base span. Repeated rows each get their row and their lines count as
one text. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, sha_hex, stored, tidy, unused

KINDS = ["email", "ip", "card", "phone", "term", "general"]
BASE = KINDS[:4]
SUPPORT = 2  # distinct line texts; fewer are no repeated evidence
CHANCE = 1e-3
DISCLOSE, REMOVE = 1.5, 1.1
BROADCAST_TERMS = 500_000  # candidate words are broadcast while they are fewer

# The base patterns. Digits before an address or number cannot start a better match, so looking behind saves retries only.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches found from each @: the name is the run of name characters before it, so the work stays linear."""
    upto, at = 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at)
        if m:
            run = at
            while run > upto and LOCAL.match(text[run - 1]):
                run -= 1
            if run < at:
                yield run, m.end()
                upto = m.end()
        at = text.find("@", max(at + 1, upto))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) by start, then kind."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if any(c in text for c in "0123456789"):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def merged(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that sorted spans cover."""
    starts: list[int] = []
    ends: list[int] = []
    for start, _, end in spans:
        if starts and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def entity_lines(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, str, list[str]]]:
    """For each line with entities: hash, start, text and distinct values. No base pattern crosses a line's end."""
    held: dict[tuple[int, int], dict[str, None]] = {}
    left, right = 0, -1
    for start, _, end in spans:
        if start >= right:
            left, right = text.rfind("\n", max(right, 0), start) + 1 or max(right + 1, 0), text.find("\n", start)
            right = len(text) if right < 0 else right
        held.setdefault((left, right), {})[text[start:end]] = None
    for (left, right), values in held.items():
        line = text[left:right]
        yield xxhash.xxh64_intdigest(line.encode()) - (1 << 63), left, line, list(values)


def free_words(line: str, left: int, starts: list[int], ends: list[int]) -> Iterator[re.Match]:
    """The words of a line that touch no stretch; the line starts at ``left`` of the text."""
    for m in WORD.finditer(line):
        k = bisect_right(starts, left + m.end() - 1) - 1
        if k < 0 or ends[k] <= left + m.start():
            yield m


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, id, text_hash, base, lines): stored; ``base`` are the base spans, ``lines`` the lines that hold any."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    span = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
    held = pa.struct([("line", pa.int64()), ("left", pa.int32()), ("text", pa.string()), ("values", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, lines = [], []
            for text in b.column(3):
                text = text.as_py()
                spans = base_spans(text)
                base.append([{"start": s, "rank": k, "end": e} for s, k, e in spans])
                lines.append([{"line": h, "left": at, "text": t, "values": v} for h, at, t, v in entity_lines(text, spans)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(base, pa.list_(span)), pa.array(lines, pa.list_(held))],
                                             names=["uid", "id", "text_hash", "base", "lines"])

    kind = rows.schema["id"].dataType.simpleString()
    return stored(rows.mapInArrow(tidy(run), f"uid bigint, id {kind}, text_hash bigint, base array<struct<start:int,rank:int,end:int>>, "
                                       "lines array<struct<line:bigint,left:int,text:string,values:array<string>>>"), "pii")


def word_lines(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, lines): in how many lines of the corpus each of ``terms`` stands outside base spans; the term '' stands for every line."""
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    wanted = stored(terms.select("term").union(docs.sparkSession.createDataFrame([("",)], "term string")), "terms")
    small = wanted.count() <= BROADCAST_TERMS
    # a list counted to be small is sent to the tasks, which then count its words alone; otherwise every word is counted and joined
    only = frozenset(r["term"] for r in wanted.collect()) if small else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            part = pa.RecordBatch.from_pydict({"term": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return part

        for b in batches:
            for text in b.column(0):
                text = text.as_py()
                starts, ends = merged(base_spans(text))
                left = 0
                for line in text.split("\n"):
                    held[""] += 1
                    k = bisect_right(starts, left + len(line)) - 1
                    if k >= 0 and ends[k] > left:
                        words = {m[0] for m in free_words(line, left, starts, ends)}
                    else:
                        words = set(WORD.findall(line))
                    held.update(words if only is None else words & only)
                    left += len(line) + 1
                if len(held) > 200_000:
                    yield out()
        if held:
            yield out()

    # added up before the join, which then has one row a word however many tasks there are; inner, as a semi join would be pushed below the sum
    counted = rows.mapInArrow(tidy(run), "term string, n bigint").groupBy("term").agg(F.sum("n").alias("lines"))
    return counted if small else counted.join(wanted, "term")


def pair_counts(scanned: DataFrame, held: DataFrame, values: DataFrame) -> DataFrame:
    """(value, term, texts, n_both): distinct lines, and lines, that hold an entity of ``values`` and a word outside base spans.

    ``held`` has (value, line, n, at): each entity's distinct lines, how often they come and where first.
    """
    asked = held.join(values.select("value"), "value", "left_semi").groupBy("at").agg(F.first("n").alias("n"), F.collect_list("value").alias("values"))
    per_row = asked.groupBy(F.col("at.uid").alias("uid")).agg(F.collect_list(F.struct("at.left", "n", "values")).alias("asked"))
    rows = scanned.select("uid", "base", F.transform("lines", lambda x: F.struct(x["left"].alias("left"), x["text"].alias("text"))).alias("lines")).join(per_row, "uid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: Counter = Counter()
        both: Counter = Counter()

        def out() -> pa.RecordBatch:
            part = pa.RecordBatch.from_pydict({"value": pa.array([v for v, _ in texts], pa.string()), "term": pa.array([t for _, t in texts], pa.string()),
                                               "texts": pa.array(list(texts.values()), pa.int64()), "n": pa.array([both[x] for x in texts], pa.int64())})
            texts.clear()
            both.clear()
            return part

        for b in batches:
            for base, lines, wanted in zip(b.column(0), b.column(1), b.column(2)):
                starts, ends = merged([(s["start"], s["rank"], s["end"]) for s in base.as_py()])
                line = {x["left"]: x["text"] for x in lines.as_py()}
                for w in wanted.as_py():
                    words = {m[0] for m in free_words(line[w["left"]], w["left"], starts, ends)}
                    for value in w["values"]:
                        for term in words:
                            texts[value, term] += 1
                            both[value, term] += w["n"]
                        if len(texts) > 100_000:
                            yield out()
        if texts:
            yield out()

    return rows.select("base", "lines", "asked").mapInArrow(tidy(run), "value string, term string, texts bigint, n bigint").groupBy("value", "term").agg(
        F.sum("texts").alias("texts"), F.sum("n").alias("n_both"))


def disclosing(scanned: DataFrame, docs: DataFrame, text_col: str = "text", support: int = SUPPORT, disclose: float = DISCLOSE, chance: float = CHANCE) -> DataFrame:
    """(value, term, strength): terms with PMI(e; t) at least IC(e) / ``disclose`` that are no coincidence; strength is PMI / IC."""
    spots = scanned.where(F.size("lines") > 0).select("uid", F.explode("lines").alias("l")).select("uid", "l.line", "l.left", F.explode("l.values").alias("value"))
    held = stored(spots.groupBy("value", "line").agg(F.count("*").alias("n"), F.min(F.struct("uid", "left")).alias("at")), "entity-lines")
    values = stored(held.groupBy("value").agg(F.sum("n").alias("n_value"), F.count("*").alias("m")).where(F.col("m") >= support), "entities")
    pairs = stored(pair_counts(scanned, held, values).where(F.col("texts") >= support), "pairs")
    counts = stored(word_lines(docs, pairs.select("term").distinct(), text_col), "word-lines")
    total = counts.where("term = ''").first()   # the number of all lines
    known = pairs.join(values, "value").join(counts, "term").withColumn("all", F.lit(float(total["lines"] if total else 0)))
    ic = -F.log(F.least(F.col("n_value") / F.col("all"), F.lit(1.0)))
    pmi = F.log(F.col("n_both") * F.col("all") / (F.col("n_value") * F.greatest("lines", "n_both")))
    share, p = F.col("texts") / F.col("m"), F.col("lines") / F.col("all")
    kl = share * F.log(share / p) + F.when((share < 1) & (p < 1), (1 - share) * F.log((1 - share) / (1 - p))).otherwise(0.0)
    rare = (share > p) & (F.col("m") * kl >= -math.log(chance))
    return known.withColumn("strength", F.when(ic > 0, pmi / ic)).where(rare & (F.col("strength") >= 1 / disclose)).select("value", "term", "strength")


def added_spans(scanned: DataFrame, told: DataFrame) -> DataFrame:
    """(uid, added): every occurrence of a disclosing term on a line that holds its entity, outside base spans, as (start, end, strength)."""
    terms = stored(told.groupBy("value").agg(F.collect_list(F.struct("term", "strength")).alias("terms")), "disclosing")
    held = scanned.where(F.size("lines") > 0).select("uid", F.explode(F.array_distinct(F.flatten("lines.values"))).alias("value"))
    per_row = held.join(terms, "value").groupBy("uid").agg(F.collect_list(F.struct("value", "terms")).alias("told"))
    rows = scanned.select("uid", "base", "lines").join(per_row, "uid")
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("strength", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for base, lines, told in zip(b.column(1), b.column(2), b.column(3)):
                starts, ends = merged([(s["start"], s["rank"], s["end"]) for s in base.as_py()])
                of = {x["value"]: x["terms"] for x in told.as_py()}
                spans = []
                for x in lines.as_py():
                    strength: dict[str, float] = {}
                    for v in x["values"]:
                        for t in of.get(v, ()):
                            strength[t["term"]] = max(strength.get(t["term"], 0.0), t["strength"])
                    if strength:
                        spans += [{"start": x["left"] + m.start(), "end": x["left"] + m.end(), "strength": strength[m[0]]}
                                  for m in free_words(x["text"], x["left"], starts, ends) if m[0] in strength]
                found.append(spans)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(span))], names=["uid", "added"])

    return rows.mapInArrow(tidy(run), "uid bigint, added array<struct<start:int,end:int,strength:double>>")


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
                  disclose: float = DISCLOSE, remove: float = REMOVE, chance: float = CHANCE) -> DataFrame:
    """(id, text_hash, spans) per row; spans (start, rank, kind, end, strength) by start, then kind."""
    scanned = scan(docs, id_col, text_col)
    added = added_spans(scanned, disclosing(scanned, docs, text_col, support, disclose, chance))
    per_row = added.select("uid", F.transform("added", lambda s: F.struct(
        s["start"].alias("start"), F.when(s["strength"] >= 1 / remove, len(BASE)).otherwise(len(BASE) + 1).alias("rank"), s["end"].alias("end"), s["strength"].alias("strength"))).alias("added"))
    full = scanned.select("uid", "id", "text_hash", "base").join(per_row, "uid", "left")
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), F.lit(None).cast("double").alias("strength")))
    both = F.sort_array(F.concat(base, F.coalesce("added", F.array().cast("array<struct<start:int,rank:int,end:int,strength:double>>"))))
    names = F.array(*map(F.lit, KINDS))
    named = F.transform(both, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), F.get(names, s["rank"]).alias("kind"), s["end"].alias("end"), s["strength"].alias("strength")))
    return full.select("id", "text_hash", named.alias("spans"))


def sanitised(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with base spans replaced by their kind, ``term`` spans removed and ``general`` spans generalised; the longer of overlapping spans wins from the left."""
    out, upto = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start < upto:
            if end > upto:
                upto = end
            continue
        word = text[start:end]
        general = "<number>" if any(c.isdigit() for c in word) else "<name>" if word[:1].isupper() else "<word>"
        out += [text[upto:start], "" if kind == "term" else general if kind == "general" else f"<{kind}>"]
        upto = end
    return "".join(out) + text[upto:]


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with personal data and disclosing terms generalised or removed; other columns as they are."""
    hit_id, hit_hash, hidden = unused(docs.columns, "_hit_id", "_hit_hash", "_spans")
    found = find_personal(docs, id_col, text_col, **how).where(F.size("spans") > 0).select(
        F.col("id").alias(hit_id), F.col("text_hash").alias(hit_hash), F.col("spans").alias(hidden)).dropDuplicates([hit_id, hit_hash])
    joined = docs.join(found, docs[id_col].eqNullSafe(found[hit_id]) & (F.xxhash64(docs[text_col]) == found[hit_hash]), "left")

    @F.pandas_udf("string")
    def clean(texts, spans):
        return texts.combine(spans, lambda t, s: t if s is None or t is None else sanitised(t, [(x["start"], x["end"], x["kind"]) for x in s]))

    return joined.select(*[clean(F.col(c), F.col(hidden)).alias(c) if c == text_col else docs[c] for c in docs.columns])


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal(read_table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return found.select(F.col("id").alias("doc_id"), *[count(k) for k in BASE], sha_hex(listed(base)).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
