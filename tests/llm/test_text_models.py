"""Language identification and language-model scores."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from panelspark.llm import language_id, lm_scoring
from tests.llm.test_dedup import ODD, words

SYLLABLES = {"aa": ["ka", "to", "mi", "re", "su"], "bb": ["sch", "en", "ung", "ber", "ü"], "cc": ["eau", "é", "que", "tion", "le"]}


def prose(lang, seed, n):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_languages_held_out(docs):
    rows = [(i, prose(lang, i, 30), lang if i % 2 else None) for i, lang in enumerate(sorted(SYLLABLES) * 40)]
    df = docs(rows, clash=True)
    model = language_id.train(df)
    assert model["langs"] == ["aa", "bb", "cc"]
    flag = (F.col("doc_id") > 5).alias("flag")
    out = language_id.predict(df, model, "text", "doc_id", flag, "component").collect()
    assert all(r["flag"] == (r["doc_id"] > 5) for r in out)
    truth = {i: lang for i, lang in enumerate(sorted(SYLLABLES) * 40)}
    assert len(out) == 120 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) >= 118
    assert all(0 <= r["score"] <= 1 and r["component"] == "x" for r in out)


def test_language_of_odd_texts_and_empty_models(docs):
    model = language_id.train(docs([(1, prose("aa", 1, 50), "aa"), (2, prose("bb", 1, 50), "bb"), (3, None, "aa"), (4, "x", None)]))
    rows = [*ODD, (20, "123 !?"), (21, "漢字"), (22, "\x00a")]
    got = {(r["doc_id"], r["text"]): r for r in language_id.predict(docs(rows), model, "text", "doc_id", "text").collect()}
    assert len(got) == len(set((i, t) for i, t in rows))
    for (_, text), r in got.items():
        letters = any(c.isalpha() for c in text or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
    nothing = language_id.train(docs([]))
    assert {r["lang_pred"] for r in language_id.predict(docs(ODD), nothing, "text", "doc_id").collect()} == {"und"}
    assert language_id.predict(docs([]), model, "text", "doc_id").count() == 0


def test_code_lengths_follow_the_escapes():
    grams = [("l", ord("c") | ord("b") << 8 | ord("a") << 16 | 10 << 24, 9), ("l", ord("b") | ord("a") << 8 | 10 << 16 | 10 << 24, 9)]
    model = language_id.fit(grams)
    bits = language_id.code_lengths(model, np.frombuffer(b"ab", np.uint8), np.array([0, 2]))[0, 0] / 1024
    # no context of line feeds alone was seen; order 0 has seen two bytes, nine times each, and not "a"
    first = -math.log2(2 / 20 / 256)
    second = -math.log2(9 / 10)
    assert abs(bits - first - second) < 0.01
    assert language_id.code_lengths(model, np.zeros(0, np.uint8), np.array([0, 0])).tolist() == [[0]]


def tokens(text):
    return [*words((text or "").translate({c: c + 32 for c in range(65, 91)})), None]


def test_scores_match_counts(docs):
    rng = random.Random(1)
    vocabulary = [f"v{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choices(vocabulary, range(200, 0, -1), k=rng.randrange(1, 60)))) for i in range(150)]
    rows += [(i + 1000, t) for i, (_, t) in enumerate(ODD)] + [(3000, rows[0][1]), (3000, rows[0][1]), (None, "v1 unseen")]
    train = lambda i: i is not None and i % 7 != 2
    out = lm_scoring.score(docs(rows, clash=True), F.pmod("doc_id", F.lit(7)) != 2).collect()
    counts = Counter(t for i, text in rows if train(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), len(tokens(x)), sum(t in counts for t in tokens(x)), round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(x)), 6))
        for i, x in rows
    )
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out)
    assert got == want and {r["train_tokens"] for r in out} == {n}
    assert all(r["held_out"] != train(r["doc_id"]) and r["score"] < 0 for r in out)


def test_score_prefers_what_it_has_seen(docs):
    a, b = "the cat sat on the mat", "mat the on sat cat the"
    rows = [(i, a) for i in range(60)] + [(100, a), (101, b)]
    got = {r["doc_id"]: r for r in lm_scoring.score(docs(rows), F.col("doc_id") < 100).collect()}
    assert got[100]["score"] > got[101]["score"] and abs(got[100]["base_score"] - got[101]["base_score"]) < 1e-9


def test_scores_without_training_and_without_rows(docs):
    got = lm_scoring.score(docs([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert {r["train_tokens"] for r in got} == {0} and all(r["base_score"] == 0 and r["n_known"] == 0 for r in got)
    assert lm_scoring.score(docs([]), F.lit(True)).count() == 0


def test_filter_counts_are_quantised_not_lost():
    rng = np.random.default_rng(2)
    hashes = np.unique(rng.integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2))
    counts = np.maximum(1, rng.zipf(1.6, len(hashes)) % 100_000)
    bits, size = lm_scoring._filter(hashes & lm_scoring._LOW, lm_scoring._levels(counts))
    row = {"range": 0, "bits": bits, "size": size, "firsts": b"", "sums": b""}
    held = lm_scoring._joined([row], 0, 1)
    probe = lambda x: lm_scoring._count_of(lm_scoring.probed(held, x, np.zeros(len(x), int)))
    got = probe(hashes)
    assert (got >= counts / 1.5 - 1e-6).all()  # never below the step of the true count
    assert (np.abs(got / counts - 1) < 0.5).mean() > 0.93
    strange = probe(rng.integers(0, 2**63, 20_000, dtype=np.uint64))
    assert (strange > 0).mean() < 0.02


def brute_model(texts):
    """Scores by the definition, without a filter: counts kept by steps, a context's share of its own sum."""
    single, pair = Counter(), Counter()
    for text in texts:
        single.update(tokens(text))
        pair.update(zip(["start", *tokens(text)], tokens(text)))

    def guessed(c):
        if not c:
            return 0
        steps = [n for n in range(1, 60) if math.ceil(1.5 ** (n - 1) - 1e-9) <= c]
        low, high = math.ceil(1.5 ** (steps[-1] - 1) - 1e-9), math.ceil(1.5 ** steps[-1] - 1e-9) - 1
        return (low + max(low, high)) / 2

    single = {k: guessed(v) for k, v in single.items()}
    pair = {k: guessed(v) for k, v in pair.items()}
    context = Counter()
    for (first, _), c in pair.items():
        context[first] += c
    whole = sum(single.values()) + len(single) + 1

    def expected(text):
        total = 0
        for a, b in zip(["start", *tokens(text)], tokens(text)):
            weight = 0.5 * context[a] / (context[a] + 2)
            total += math.log10(weight * pair.get((a, b), 0) / max(context[a], 1) + (1 - weight) * (single.get(b, 0) + 1) / whole)
        return total

    return expected


def test_scores_match_brute_force_however_small_ranges_and_slices(docs, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(6000 * rng.random() ** 3)}" for _ in range(40))) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 400, 4)] + [(5000 + i, t) for i, (_, t) in enumerate(ODD)]
    expected = brute_model([text for _, text in rows[:400]])
    want = sorted((i, expected(text)) for i, text in rows)

    def got(**sizes):
        out = lm_scoring.score(docs(rows), F.col("doc_id") < 1000, **sizes).collect()
        return sorted((r["doc_id"], round(r["score"], 9)) for r in out)

    some = got(most_bytes=1 << 16, slice_bytes=1 << 13)
    assert some == got(most_bytes=1 << 16)
    assert abs(sum(x for _, x in some) / sum(x for _, x in want) - 1) < 0.005
    # with a filter that hardly errs, every single score is that of the definition
    monkeypatch.setattr(lm_scoring, "BITS", 400)
    monkeypatch.setattr(lm_scoring, "HASHES", 8)
    for (_, a), (_, b) in zip(got(most_bytes=1 << 15), want):
        assert abs(a - b) < 1e-4


def test_a_saved_model_scores_texts_it_has_not_seen(spark, docs, tmp_path):
    rng = random.Random(6)
    text = lambda: " ".join(f"w{int(900 * rng.random() ** 2)}" for _ in range(30))
    old, new = [(i, text()) for i in range(200)], [(i, text()) for i in range(500, 560)] + ODD + [(900, "never heard of")]
    lm_scoring.save(lm_scoring.fit(docs(old)), str(tmp_path / "model"))
    model = lm_scoring.load(spark, str(tmp_path / "model"))
    pairs = lambda df: sorted((-1 if r["doc_id"] is None else r["doc_id"], r["score"]) for r in df.collect())
    got = pairs(lm_scoring.apply(docs(new, clash=True), model, slice_bytes=1 << 12))
    both = lm_scoring.score(docs([*old, *new]), F.col("doc_id").isin([i for i, _ in old]) & F.col("text").isin([t for _, t in old]))
    held = pairs(both.filter("held_out"))
    # which contexts are spread differs, and with them the filter's mistakes
    assert [i for i, _ in got] == [i for i, _ in held]
    assert abs(sum(x for _, x in got) / sum(x for _, x in held) - 1) < 0.005
    expected = brute_model([t for _, t in old])
    assert abs(sum(x for _, x in got) / sum(expected(t) for _, t in new) - 1) < 0.005
    assert lm_scoring.apply(docs([]), model).count() == 0
    empty = lm_scoring.apply(docs(new), lm_scoring.fit(docs([]))).collect()
    assert all(r["score"] == 0 for r in empty) and len(empty) == len(new)


def test_probabilities_of_all_texts_sum_to_one(docs):
    rng = random.Random(8)
    known = [f"w{i}" for i in range(12)]
    model = lm_scoring.fit(docs([(i, " ".join(rng.choices(known, range(1, 13), k=rng.randrange(12)))) for i in range(300)]))
    all_words = [*known, "unknown"]
    asked = ["", *all_words, *(f"{a} {b}" for a in all_words for b in all_words)]
    got = {r["doc_id"]: 10 ** r["score"] for r in lm_scoring.apply(docs(list(enumerate(asked))), model).collect()}
    single = np.array([got[1 + i] for i in range(13)])
    # a text's probability is that of its first word as a text times the change with each further word
    change = np.array([[got[14 + 13 * i + j] for j in range(13)] for i in range(13)]) / single[:, None]
    assert abs(got[0] + single @ np.linalg.solve(np.eye(13) - change, np.ones(13)) - 1) < 0.01


def ppm(grams, order=3, least=8):
    """Cost function of one language by the definition, in units of 1/1024 bit."""
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for run, n in grams.items():
        for o in range(order + 1):
            counts[o][run[order - o : order]][run[order]] += n

    def cost(run):
        bits = 0
        for o in range(order, -1, -1):
            seen = counts[o].get(run[order - o : order])
            if seen is None or (o == order and sum(seen.values()) < least):
                continue
            total = sum(seen.values()) + len(seen)
            if run[order] in seen:
                return bits + round(-math.log2(seen[run[order]] / total) * 1024)
            bits += round(-math.log2(len(seen) / total) * 1024)
        return bits + 8 * 1024

    return cost


def test_code_lengths_match_brute_force(spark, docs):
    rng = random.Random(5)
    alphabets = {"aa": "abc d", "bb": "".join(map(chr, range(0x400, 0x520))), "cc": "abé\n\x7f"}
    text = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    rows = [(i, text(a, rng.randrange(1, 200)), lang) for i in range(60) for lang, a in alphabets.items()]
    model = language_id.train(docs(rows))
    assert model["langs"] == sorted(alphabets)
    grams = {lang: Counter() for lang in alphabets}
    bytes_of = lambda t: b"\n\n\n" + bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode())
    for _, t, lang in rows:
        b = bytes_of(t)
        grams[lang].update(tuple(b[i - 3 : i + 1]) for i in range(3, len(b)))
    costs = {lang: ppm(grams[lang]) for lang in alphabets}
    probes = [text(a, n) for a in [*alphabets.values(), "ABxyz", "".join(map(chr, range(1, 0x3000, 7)))] for n in (0, 1, 2, 50, 300)]
    data = [t.encode() for t in probes]
    offsets = np.cumsum([0, *map(len, data)])
    got = language_id.code_lengths(model, np.frombuffer(b"".join(data), np.uint8), offsets)
    for t, row in zip(probes, got):
        b = bytes_of(t)
        want = [sum(costs[lang](tuple(b[i - 3 : i + 1])) for i in range(3, len(b))) for lang in model["langs"]]
        assert row.tolist() == want


def test_rare_bytes_of_many_scripts_tell_languages_apart(spark, docs):
    """Two languages that share most byte values and differ in the rare ones."""
    rng = random.Random(6)
    chars = [chr(x) for x in (*range(1, 65), *range(91, 128), *range(0x80, 0x800, 3))]
    rare = {"aa": [chr(0x1000 * i + 0x3F) for i in range(1, 8)], "bb": [chr(0x1000 * i + 0x3F) for i in (8, 9, 10, 11, 12, 14, 15)]}
    rows = []
    for i in range(300):
        lang = "ab"[i % 2] * 2
        common = "".join(rng.choice(chars) for _ in range(400))
        rows.append((i, common + "".join(rng.choice(rare[lang]) for _ in range(4)), lang))
    model = language_id.train(docs(rows))
    assert len({int(x) for tree in model["trees"] for x in tree[0][0]}) > 160
    probes = [(1000 + i, "".join(rng.choice(rare["ab"[i % 2] * 2]) for _ in range(5))) for i in range(100)]
    told = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs([(i, "x" + t) for i, t in probes]), model, "text", "doc_id").collect()}
    assert all(told[i] == "ab"[i % 2] * 2 for i, _ in probes)
