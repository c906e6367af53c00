"""The corpus pipeline against brute force, stage by stage, and the registered queries."""

import random
from collections import defaultdict

import corpus_pipeline
import pytest

from tests.llm.test_dedup import jaccard_links, kept_lines, roots, words
from tests.llm.test_mix_pack import reshared
from tests.llm.test_text_models import SYLLABLES, prose


@pytest.fixture()
def raw(docs):
    rng = random.Random(11)
    shared = ["\n".join(prose("aa", f"s{k}{i}", 8) for i in range(8)) for k in range(4)]
    rows = []
    for i in range(150):
        lang = sorted(SYLLABLES)[i % 3]
        text = prose(lang, i, 60)
        if rng.random() < 0.4:
            text += "\n" + rng.choice(shared) + "\nend " + prose(lang, -i, 3)
        rows.append((i, text, lang if i % 4 else None, f"s{i % 5}" if i % 11 else None))
    for i in range(40):
        w = rows[i % 13][1].split(" ")
        w[rng.randrange(40)] = "changed"
        rows.append((200 + i, " ".join(w), None, "s1"))
    rows += [(300, None, "aa", "s1"), (301, "12 34 --", None, "s2"), (302, "", None, None), (None, prose("bb", 999, 50), None, None)]
    return rows


def run_stage(spark, docs, n):
    name, stage = corpus_pipeline.STAGES[n]
    return stage(spark, docs, "")


def test_stages_match_brute_force(spark, docs, raw):
    df = docs(raw, clash=False)
    table = run_stage(spark, df, 0)
    assert table.columns == df.columns
    left = {r["doc_id"]: r["text"] for r in table.collect()}
    assert set(left) == {r[0] for r in raw} - {300, 301, 302}

    table = run_stage(spark, table, 1)
    order = sorted(left, key=lambda i: (i is not None, i))
    want = {i: "\n".join(lines) for i, lines in zip(order, kept_lines([left[i] for i in order]))}
    rows = table.collect()
    assert {r["doc_id"]: r["text"] for r in rows} == want and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert want != left

    table = run_stage(spark, table, 2)
    known = [(i, t) for i, t in want.items() if i is not None]
    sets, links = jaccard_links(known, 5)
    group = roots(sets, links)
    kept = {r["doc_id"] for r in table.collect()}
    assert kept == {i for i in sets if group[i] == i} | {None} and len(kept) < len(want)

    source = {r[0]: r[3] for r in raw}
    sizes = defaultdict(int)
    for i in kept:
        sizes[source[i]] += len(words(want[i]))
    table = run_stage(spark, table, 3)
    taken = defaultdict(int)
    for r in table.collect():
        taken[source[r["doc_id"]]] += len(words(r["text"]))
        assert words(want[r["doc_id"]])[: len(words(r["text"]))] == words(r["text"])
    target = reshared(sizes)
    assert all(0 <= target[s] - taken[s] < 1 + 1e-6 for s in sizes)

    total = sum(taken.values())
    packed = run_stage(spark, table, 4).collect()
    assert sum(r["length"] for r in packed) == total
    filled = defaultdict(int)
    for r in packed:
        filled[r["bin_id"]] += r["length"]
    assert all(filled[r["bin_id"]] == r["filled"] <= r["capacity"] for r in packed)


def test_run_applies_all_stages(spark, docs, raw, tmp_path):
    docs(raw).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns[:4] == ["doc_id", "piece", "start", "length"] and out.count() > 50
    docs([]).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= names


def test_language_stage_tells_gibberish_from_ambiguous(spark, docs):
    rng = random.Random(8)
    rows = [(i, prose(lang, i, 40), lang) for i, lang in enumerate(sorted(SYLLABLES) * 40)]
    # "dd" is a copy of "aa", "ee" another: three languages that code a text alike
    rows += [(1000 + 200 * k + r[0], r[1], name) for k, name in enumerate(("dd", "ee")) for r in rows[:120] if r[2] == "aa"]
    rows += [(5000 + i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400)), None) for i in range(5)]
    rows += [(6000 + i, "".join(rng.choice("žлщ юдфґñ") for _ in range(300)), None) for i in range(2)]
    rows += [(7000, "kato", None), (7001, "mi re", None)] + [(7100 + i, prose("aa", 500 + i, 40), None) for i in range(20)]
    kept = {r["doc_id"] for r in run_stage(spark, docs(rows), 0).collect()}
    assert kept == {r[0] for r in rows if not 5000 <= r[0] < 7000}


def test_language_stage_without_labels(spark, docs, raw):
    rows = [(i, text, None, source) for i, text, _, source in raw]
    kept = run_stage(spark, docs(rows), 0)
    assert kept.columns == docs(rows).columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {300, 301, 302}
