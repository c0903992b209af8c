import random
import re

from postscope.llm import pii as S

DOCS = "doc_id bigint, text string, uid string, base string, seen string, kind string"
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(s):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(s)))) % 10 == 0


def fits(kind, m):
    d = re.sub("[^0-9]", "", m)
    return [lambda: True, lambda: all(int(x) <= 255 for x in m.split(".")), lambda: 14 <= len(d) <= 19 and luhn(d), lambda: 10 <= len(d) <= 15][kind]()


def brute(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if fits(k, m[0]))


TRICKY = ["", "a.b@c.de", "a@@b.c.d@e.f", "x@y", "@a.b", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "0001.002.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111", "+1 (212) 555-0100)",
          "+12 3", "++1234567890", "+1234567890123456", "é+1 234 567 8901é", "a" * 5000 + "@b.c", "1" * 5000, "1." * 3000, "@" * 3000, "a@b" * 2000, "+1" * 2000, "%+-@-.-"]


def test_base_spans_equal_brute_force():
    rng = random.Random(7)
    texts = TRICKY + ["".join(rng.choice(["a", "Z", "@", ".", "1", "25", "256", " ", "-", "+", "(", ")", "4111111111111111", "é", "%", "\n", "a@b.c", "+1 2345678901"]) for _ in range(rng.randrange(40))) for _ in range(5000)]
    for t in texts:
        assert S.base_spans(t) == brute(t), t[:80]


def found(spark, docs, **how):
    rows = spark.createDataFrame([(*d, "a", "b", "c", "d") for d in docs], DOCS)
    return sorted(((r.id, [(s.kind, s.start, s.end) for s in r.spans]) for r in S.find_personal(rows, **how).collect()), key=str)


def planted():
    """A nickname stands by one address in many different lines and nowhere else; a common word stands by all."""
    filler = [(100 + k, f"the plain line number{k} has words and the river\nthe second line{k}") for k in range(300)]
    docs = [(k, f"intro{k} Falcon the writes from j.doe@mail.example.com often{k}") for k in range(6)]
    other = [(20 + k, f"the note{k} goes to x{k}@mail.example.com today") for k in range(6)]
    return docs + other + filler


def test_disclosing_terms_are_added_and_common_words_are_not(spark):
    docs = planted()
    got = dict(found(spark, docs))
    for k in range(6):
        text = docs[k][1]
        words = {text[a:b] for kind, a, b in got[k] if kind in ("term", "general")}
        assert {"Falcon", "writes"} <= words and "the" not in words and f"intro{k}" not in words
        assert any(kind == "email" for kind, *_ in got[k])
    assert all([kind for kind, *_ in got[20 + k]] == ["email"] for k in range(6))
    assert all(got[100 + k] == [] for k in range(300))


def test_copies_of_one_line_are_no_evidence(spark):
    docs = [(k, "Falcon writes from j.doe@mail.example.com") for k in range(9)] + [(50 + k, f"line{k}") for k in range(50)]
    assert all(all(kind == "email" for kind, *_ in s) for _, s in found(spark, docs))


def test_sanitise_removes_and_generalises(spark):
    rows = spark.createDataFrame([(*d, "a", "b", "c", "d") for d in planted()], DOCS)
    out = S.sanitise(rows)
    assert out.columns == rows.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] == "intro0  the   <email> often0"
    assert got[100] == planted()[12][1]
    assert S.sanitised("ab 12 Cd ef a@b.c", [(0, 2, "term"), (3, 5, "general"), (6, 8, "general"), (9, 11, "general"), (12, 17, "email")]) == " <number> <name> <word> <email>"


def test_nulls_repeats_long_and_empty(spark):
    docs = [(1, None), (None, "a@b.cc"), (2, ""), (3, "a@b.cc"), (3, "a@b.cc"), (4, "w " * 100000 + "1.2.3.4 " + "v " * 100000), (5, "x@y.zz " * 3000)]
    got = found(spark, docs)
    assert len(got) == len(docs)
    assert [s for i, s in got if i == 3] == [[("email", 0, 6)]] * 2
    assert [len(s) for i, s in got if i == 5] == [3000]
    assert found(spark, []) == []
    assert S.sanitise(spark.createDataFrame([], DOCS)).count() == 0


def test_two_distinct_lines_and_whole_lines_are_evidence(spark):
    """The terms stand far from the address, in two different lines only; each of their occurrences there is masked."""
    far = " ".join(f"w{k}" for k in range(20))
    lines = ["Falcon pilot {} from j.doe@mail.example.com first {} Falcon", "second j.doe@mail.example.com is {} called Falcon by the pilot {}"]
    docs = [(k, line.format(far, "and " + far)) for k, line in enumerate(lines)] + [(2, "Falcon elsewhere\nnothing here")]
    docs += [(100 + k, f"the plain line{k} and {far}\nthe second is from line{k} first called by") for k in range(300)]
    got = dict(found(spark, docs))
    for k, n in ((0, 2), (1, 1)):
        words = [docs[k][1][a:b] for kind, a, b in got[k] if kind in ("term", "general")]
        assert words.count("Falcon") == n and words.count("pilot") == 1 and set(words) == {"Falcon", "pilot"}
    assert got[2] == [] and all(got[100 + k] == [] for k in range(300))


def test_words_of_common_lines_are_coincidence(spark):
    docs = [(0, "red x@y.zz one"), (1, "two x@y.zz red")] + [(10 + k, f"red line{k}" if k % 4 == 0 else f"line{k}") for k in range(40)]
    assert all([kind for kind, *_ in s] == ["email"] * (i < 2) for i, s in found(spark, docs))


def plain_disclosing(docs, support, disclose, chance):
    """(value, term): PMI over whole lines, counted pair by pair."""
    import math
    lines = []
    for _, t in docs:
        spans = S.base_spans(t or "")
        at = 0
        for line in (t or "").split("\n"):
            own = [(s, e) for s, _, e in spans if at <= s < at + len(line)]
            values = {(t or "")[s:e] for s, e in own}
            words = {m[0] for m in S.WORD.finditer(line) if not any(s < at + m.end() and at + m.start() < e for s, e in own)}
            lines.append((line, values, words))
            at += len(line) + 1
    n, out = len(lines), set()
    for v in {v for _, values, _ in lines for v in values}:
        mine = [x for x in lines if v in x[1]]
        texts = {x[0]: x[2] for x in mine}
        for term in {w for words in texts.values() for w in words}:
            k, m = sum(term in words for words in texts.values()), len(texts)
            both, having = sum(term in x[2] for x in mine), sum(term in x[2] for x in lines)
            p, share = having / n, k / m
            if k < support or m < support or share <= p:
                continue
            kl = share * math.log(share / p) + ((1 - share) * math.log((1 - share) / (1 - p)) if share < 1 else 0)
            ic = -math.log(len(mine) / n)
            pmi = math.log(both * n / (len(mine) * having))
            if m * kl >= -math.log(chance) and ic > 0 and pmi / ic >= 1 / disclose:
                out.add((v, term))
    return out


def test_disclosing_terms_equal_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(30)]
    docs = []
    for k in range(160):
        line = rng.sample(words, rng.randrange(1, 6))
        if rng.random() < 0.25:
            who = rng.randrange(4)
            line += [f"p{who}@mail.example.com", f"nick{who}" if rng.random() < 0.8 else "other", f"late{rng.randrange(6)}"]
        rng.shuffle(line)
        docs.append((k, " ".join(line) + ("\n" + " ".join(rng.sample(words, 2)) if k % 3 else "")))
    docs += docs[:10] + [(None, None)]
    rows = spark.createDataFrame([(*d, "a", "b", "c", "d") for d in docs], DOCS)
    how = dict(support=2, disclose=4.0, chance=0.05)
    want = plain_disclosing(docs, **how)
    assert len(want) > 4
    for most in (S.BROADCAST_TERMS, 0):     # the list sent to the tasks, and joined
        monkeypatch.setattr(S, "BROADCAST_TERMS", most)
        scanned = S.scan(rows)
        assert {(r["value"], r["term"]) for r in S.disclosing(scanned, rows, **how).collect()} == want


def test_sanitise_passes_clashing_columns_on(spark):
    rows = spark.createDataFrame([(1, "to a@b.cc", "x", "y", "z")], "doc_id bigint, text string, _spans string, _hit_id string, _hit_hash string")
    assert [tuple(r) for r in S.sanitise(rows).collect()] == [(1, "to <email>", "x", "y", "z")]
