import zlib

import numpy as np
import pytest
from cases import crowded, documents, rows, words

from tillstar.llm import decision_list, nbsvm

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def brute_statistics(text):
    text = text or ""
    w = words(text)
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    inside = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    duplicate = sum(x in lines[:k] for k, x in enumerate(lines))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, duplicate, len(inside)


def test_statistics_and_base_rules(spark):
    given = [r if len(r[1] or "") < 10_000 else (*r[:1], r[1][:4000], *r[2:]) for r in rows()]
    given += [(50, "a b c a b c d a b\n#x\n#x\n\n \n#x ", None, None, None)]
    stats = decision_list.text_statistics(crowded(documents(spark, given)))
    got = decision_list.filter_quality(stats, []).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = []
    for doc_id, text, *_ in given:
        found = brute_statistics(text)
        failed = found[0] < 50 or 100 * found[4] > 50 * found[0]
        want.append((doc_id, *found, failed, not failed))
    have = [(r.doc_id, *(r[n] for n in names), r.base_failed, r.kept) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_lists_are_learned_pruned_and_ordered():
    r = np.random.default_rng(5)
    n = 4000
    columns = {"x": r.random(n), "y": r.random(n), "noise": r.random(n)}
    bad = ((columns["x"] > 0.8) & (columns["y"] <= 0.5)) | (columns["y"] > 0.9)
    rules = decision_list.learn(columns, bad)
    caught = np.zeros(n, bool)
    for rule in rules:
        caught |= decision_list._caught(rule, columns, n)
    assert (caught == bad).mean() > 0.97
    assert {c.feature for rule in rules for c in rule} <= {"x", "y"}
    assert decision_list.learn(columns, np.zeros(n, bool)) == []
    assert decision_list.learn(columns, r.random(n) < 0.1) == []
    assert decision_list.learn({"x": np.zeros(0)}, np.zeros(0, bool)) == []


def test_the_expression_says_what_the_rules_say(spark):
    condition = decision_list.Condition
    rules = [
        (condition("symbols_per_word", True, 0.2), condition("words", False, 100.0)),
        (condition("words_said_twice", True, 0.3),),
    ]
    stats = decision_list.text_statistics(documents(spark))
    got = decision_list.filter_quality(stats, rules).collect()
    for r in got:
        caught = (r.n_symbols / max(r.n_words, 1) > 0.2 and r.n_words <= 100) or (
            r.n_twice / max(r.n_words, 1) > 0.3
        )
        assert r.kept == (not r.base_failed and not caught)
    assert str(rules[0][0]) == "symbols_per_word > 0.2"


def corpus(n=400):
    r = np.random.default_rng(6)
    vocabulary = ["".join(r.choice(list("abcdefghij"), 5)) for _ in range(300)]
    out, labels = [], []
    for k in range(n):
        text = " ".join(r.choice(vocabulary, 80))
        kind = k % 8
        if kind == 0:
            text = " ".join(w + r.choice(["&&&", "###"]) for w in text.split())
        if kind == 1:
            text = " ".join(w for w in text.split()[:20] for _ in range(4))
        out.append((k, text, None, None, None))
        labels.append((k, int(kind > 1), 0))
    return out, labels


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = corpus()
    extra = [(5, None, 1), (None, 0, 0), (9999, 1, 0), (2, 1, 0)]  # null, unknown and repeated
    labels_df = spark.createDataFrame(labels + extra, "doc_id long, quality int, toxic int")
    return documents(spark, docs), labels_df, dict((k, q) for k, q, _ in labels)


def test_decision_list_from_tables(spark, learned):
    docs, labels, truth = learned
    stats = decision_list.text_statistics(docs)
    rules = decision_list.learn_rules(stats, labels)
    got = {r.doc_id: r.kept for r in decision_list.filter_quality(stats, rules).collect()}
    assert got == {k: bool(q) for k, q in truth.items()}
    assert decision_list.learn_rules(stats, labels.limit(0)) == []


def test_classifier_on_held_out_rows(spark, learned):
    docs, labels, truth = learned
    model = nbsvm.fit(docs, labels)
    got = {r.doc_id: r.score for r in nbsvm.score(docs, model).collect()}
    held = [k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(held) > 40
    right = sum((got[k] >= 0.3) == bool(truth[k]) for k in held)
    assert right == len(held)
    # Labels of held-out rows do not matter.
    flipped = labels.selectExpr(
        "doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) quality"
    )
    again = nbsvm.fit(docs, flipped)
    assert np.array_equal(again.weights, model.weights) and again.slope == model.slope


def test_a_bounded_sample_is_enough(spark, learned):
    docs, labels, _ = learned
    sample = nbsvm.labelled_sample(docs, labels, most=50)
    assert sample.count() == 50 and sample.where("fold = 0").count() == 0


def test_scores_of_awkward_rows(spark, learned):
    docs, labels, _ = learned
    model = nbsvm.fit(docs, labels)
    table = crowded(documents(spark))
    out = nbsvm.score(table, model, into="__score")
    assert out.columns == [*table.columns, "__score"] and out.count() == len(rows())
    assert all(0 <= r["__score"] <= 1 for r in out.collect())
    by_text = {}
    for r in out.collect():
        by_text.setdefault(r.text or "", set()).add(r["__score"])
    assert all(len(s) == 1 for s in by_text.values())
    nothing = nbsvm.fit(documents(spark, []), labels)
    assert nbsvm.score(documents(spark), nothing).where("score = 0.5").count() == len(rows())
    assert nbsvm.score(documents(spark, []), model).count() == 0


def test_indicators():
    assert nbsvm.indicators(b"").tolist() == []
    assert len(nbsvm.indicators(b"abcabc")) == 3
    marks = set(nbsvm.indicators(b"x x x y").tolist()) - set(range(nbsvm._TRIGRAMS))
    of = nbsvm._TRIGRAMS
    # 1 1 0: single marks, pairs and the triple, each with a leading one.
    assert marks == {of + 0b10, of + 0b11, of + 0b111, of + 0b110, of + 0b1110}


def test_dual_coordinate_descent_separates():
    r = np.random.default_rng(8)
    rows_, good = [], []
    for k in range(200):
        label = k % 2 == 0
        base = r.choice(50, 10, replace=False) + (0 if label else 40)
        rows_.append(np.unique(base).astype(np.uint16))
        good.append(label)
    good = np.array(good)
    ratios = nbsvm.count_ratios(rows_, good)
    assert ratios[10] > 0 > ratios[80]
    weights, bias = nbsvm.descend(rows_, good, ratios)
    model = nbsvm.Model(weights, ratios, bias, 1.0, 0.0)
    margins = np.array([model.margin(x) for x in rows_])
    assert ((margins > 0) == good).all()
    slope, shift = nbsvm.sigmoid(margins, good)
    assert slope > 0


def test_long_texts_are_taken_in_chunks(monkeypatch):
    from test_llm_pairs import fingerprint

    from tillstar.llm import common, simhash

    def small(raw, most=0):
        return common.word_chunks(raw, 16)

    whole = [nbsvm.indicators((r[1] or "").encode()).tolist() for r in rows()]
    monkeypatch.setattr(nbsvm, "_CHUNK", 16)
    monkeypatch.setattr(simhash, "word_chunks", small)
    for (_, text, *_), features in zip(rows(), whole):
        raw = (text or "").encode()[:20_000]
        cut = raw.decode(errors="ignore")
        assert [w for part in small(raw) for w in part] == raw.split()
        if len(text or "") <= 20_000:
            assert nbsvm.indicators(raw).tolist() == sorted(features)
            assert simhash.fingerprint_of(raw) == fingerprint(cut)
        assert decision_list.repeated_words(raw, 8) == decision_list.repeated_words(raw)


def test_the_classifier_equals_a_plain_one():
    """Ratios from plain counts; weights against a plain solver of the same problem, run
    until primal and dual objective meet."""
    import math

    draw = np.random.default_rng(11)
    used = np.array([5, 77, 300, 4096, nbsvm._TRIGRAMS + 3, nbsvm._FEATURES - 1, 9, 10, 11, 12])
    chance = np.where(np.arange(10) % 2, 0.6, 0.35)
    good = draw.random(120) < 0.4
    rows = [
        np.sort(used[draw.random(10) < np.where(label, chance, 1 - chance)]).astype(np.uint16)
        for label in good
    ]
    ratios = nbsvm.count_ratios(rows, good)
    total = [sum(len(r) for r, g in zip(rows, good) if g == label) + nbsvm._FEATURES for label in (0, 1)]
    for f in used.tolist():
        held = [1 + sum(f in r for r, g in zip(rows, good) if g == label) for label in (0, 1)]
        assert math.isclose(ratios[f], math.log(held[1] / total[1] / (held[0] / total[0])))
    x = np.zeros((len(rows), len(used) + 1))
    for k, r in enumerate(rows):
        value = np.array([ratios[f] if f in r else 0.0 for f in used])
        x[k, :-1] = value / (np.sqrt((value**2).sum()) or 1)
        x[k, -1] = 1  # the bias, as a feature that all rows have
    y = np.where(good, 1.0, -1.0)

    def primal(w):
        return 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w)).sum()

    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1])
    for _ in range(3000):
        for k in range(len(y)):
            new = min(max(alpha[k] - (y[k] * (x[k] @ w) - 1) / (x[k] @ x[k]), 0), 1)
            w += (new - alpha[k]) * y[k] * x[k]
            alpha[k] = new
    assert primal(w) - (alpha.sum() - 0.5 * w @ w) < 1e-6 * primal(w)
    weights, bias = nbsvm.descend(rows, good, ratios, passes=2000)
    ours = np.append(weights[used], bias)
    assert primal(ours) < 1.001 * primal(w)
    assert np.abs(x @ ours - x @ w).max() < 0.1
    assert not np.delete(weights, used).any()
