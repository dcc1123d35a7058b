"""The audit against a plain version, odd rows included; the skyband against its definition."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from radiolith.llm import divergence


def plain_audit(rows, min_documents=10, top=10):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        group = (lang or "", source or "")
        groups.add(group)
        counts[group].update(terms)
        held[group[0]].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= min_documents]
        sources = sorted(s for at, s in groups if at == lang)
        total = {t: sum(counts[lang, s][t] for s in sources) for t in kept}

        def shares(n):
            whole = sum(n[t] for t in kept)
            return {t: 1 + 1000000000 * (n[t] + 2) // (whole + 2 * len(kept)) for t in kept}

        of = {s: shares(counts[lang, s]) for s in sources}
        q = shares(total)
        for s in sources:
            p = of[s]
            pairs = [(-sum((p[t] - of[o][t]) ** 2 // (p[t] + of[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(-((p[t] - q[t]) ** 2 // (p[t] + q[t])), t) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found = sorted(found, key=lambda x: (x[0], x[1].encode()))[: None if part == "pair" else top]
                out += [(lang, s, part, item, -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


def audited(frame, **more):
    return sorted(tuple(r) for r in divergence.audit(frame, **more).collect())


def made_rows(seed, n=300):
    pick = random.Random(seed)
    words = ["the", "Of", "straße", "été", "日本", "a", "b", "c", "zeta", "OMEGA", "𝔘", "�"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for _ in range(n):
        lang, source = pick.choice(["en", "de", None]), pick.choice(["s", "t", "u", "", None])
        rows.append((" ".join(pick.choices(words, [1 / (i + 1) for i in range(len(words))], k=pick.randrange(12))), lang, source))
    return rows


def test_against_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(divergence, "FAN_IN", 2)
    rows = made_rows(1) + [(None, "en", "s"), ("", "xx", "alone"), ("1 2 - 3", "yy", "a"), ("rare", "yy", "b"), ("the " * 100000, "en", "long")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").repartition(6)
    assert audited(frame) == plain_audit(rows)
    assert audited(frame, min_documents=2, top=3) == plain_audit(rows, 2, 3)
    odd = frame.withColumns({"term": F.lit(1), "part": F.lit(2), "n": F.lit("x"), "bucket": F.array(F.lit(1))})
    assert audited(odd.union(odd)) == plain_audit(rows + rows)
    assert audited(frame.limit(0)) == []


def test_small_batches_and_many_sources(spark, monkeypatch):
    rows = [(t, "en", f"s{i % 40}") for i, (t, _, _) in enumerate(made_rows(2, 400))]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(divergence, "CHUNK", 3)
    assert audited(frame, min_documents=3) == plain_audit(rows, 3)
    batches = frame.toArrow().to_batches(max_chunksize=50)
    whole = Counter()
    monkeypatch.setattr(divergence, "HELD", 5)
    for part in divergence.count_terms(batches):
        for r in part.to_pylist():
            whole[r["source"], r["term"]] += r["n"]
    assert sum(whole.values()) == sum(len((t or "").split()) for t, _, _ in rows)


def test_skyband_by_definition():
    pick = random.Random(3)
    for k in (1, 2, 5):
        for size in (0, 1, 200):
            rows = [(pick.randrange(12), pick.randrange(12), pick.choice("abcdefgh") + pick.choice("xyé")) for _ in range(size)]
            rows = list(dict.fromkeys(rows))
            want = {
                i for i, (n, total, term) in enumerate(rows)
                if sum(m >= n and o <= total and u.encode() <= term.encode() and j != i for j, (m, o, u) in enumerate(rows)) < k
            }
            assert set(divergence.skyband(*(list(c) for c in zip(*rows)) if rows else ([], [], []), k)) == want


def test_values_are_whole_at_any_size(spark):
    counts = [(0, 1, 1), (10**12, 3 * 10**13, 10**9), (5, 10**18, 7)]
    frame = spark.createDataFrame(counts, "n long, whole long, kept long")
    got = [r[0] for r in frame.select(divergence._share(F.col("n"), F.col("whole"), F.col("kept"))).collect()]
    assert got == [1 + 10**9 * (n + 2) // (w + 2 * v) for n, w, v in counts]
