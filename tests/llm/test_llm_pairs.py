"""SimHash and MinHash against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import classes, crowded, documents, lower, rows, words
from pyspark.sql import functions as F

from tillstar.llm import minhash, minhash_classes, simhash
from tillstar.llm.components import components


def fingerprint(text):
    w = words(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def smallest(ids, root):
    """The smallest id of each one's class, nulls last."""
    out = []
    for r in root:
        known = [i for i, other in zip(ids, root) if other == r and i is not None]
        out.append(min(known, default=None))
    return out


def test_simhash_equals_brute_force(spark):
    given = rows()
    prints = [fingerprint(r[1]) for r in given]
    ids = [r[0] for r in given]
    root = classes(len(given), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    got = simhash.near_duplicates(crowded(documents(spark))).collect()
    got = sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got), key=repr)
    assert got == sorted(zip(ids, prints, smallest(ids, root)), key=repr)


def chained(n, seed, flips):
    """Fingerprints in chains and clusters, some far from all others."""
    r = random.Random(seed)
    out = [r.getrandbits(64) for _ in range(n // 4)]
    while len(out) < n:
        x = r.choice(out[-8:])
        for _ in range(r.choice(flips)):
            x ^= 1 << r.randrange(64)
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("chunk", [4096, 5])
@pytest.mark.parametrize("flips", [(1, 2, 3), (3, 4, 5, 6)])
def test_links_connect_what_is_near_however_small_the_tasks(spark, chunk, flips):
    prints = chained(160, 1, flips)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fingerprint long")
    found = components(simhash.links(df, chunk=chunk)).collect()
    got = {r.node % 2**64: r.root for r in found}
    root = classes(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    want = {}
    for i, p in enumerate(prints):
        members = [prints[j] for j in range(len(prints)) if root[j] == root[i]]
        if len(members) > 1:
            want[p] = min(map(simhash._signed, members))
    assert got == want


def test_a_hot_key_of_far_fingerprints_is_taken_apart(spark):
    """All share one key; the rest of their bits is random, with near ones among them."""
    random_ = np.random.default_rng(5)
    n, bits = 20_000, simhash.key_masks(20_000)[0]
    prints = random_.integers(0, 1 << 64, n, np.uint64) & np.uint64(~bits % 2**64)
    free = [b for b in range(64) if not bits >> b & 1]
    for k in range(0, 2000, 2):
        flips = random_.choice(free, random_.integers(1, 7), replace=False)
        prints[k] = prints[k + 1] ^ np.uint64(sum(1 << int(b) for b in flips))
    prints = np.unique(prints)
    df = spark.createDataFrame([(simhash._signed(int(p)),) for p in prints], "fingerprint long")
    got = {r.node % 2**64: r.root for r in components(simhash.links(df)).collect()}
    near = set()
    for at in range(0, len(prints), 500):
        i, j = np.nonzero(np.bitwise_count(prints[at : at + 500, None] ^ prints[None]) <= 4)
        near |= {(int(prints[a + at]), int(prints[b])) for a, b in zip(i, j) if a + at != b}
    assert len(near) > 1000 and set(got) == {a for a, _ in near}
    assert all(got[a] == got[b] for a, b in near)
    groups = {}
    for node, root in got.items():
        groups.setdefault(root, set()).add(node)
    linked = {}
    for a, b in near:
        linked.setdefault(a, set()).add(b)
    for members in groups.values():  # no more than what is connected
        seen, todo = set(), [next(iter(members))]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += linked[x]
        assert seen == members


def test_finer_keys_lose_no_link():
    r = random.Random(6)
    for mask in (0, (1 << 21) - 1, (1 << 55) - 1, (1 << 58) - 1, (1 << 62) - 1):
        finer = simhash.finer_masks(mask, 4)
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(200):
            changed = sum(1 << b for b in r.sample(free, min(4, len(free))))
            assert any(not f & changed for f in finer) or len(free) <= 4
        assert all(f & mask == mask and (f != mask or len(free) <= 4) for f in finer)


def test_of_rows_that_differ_elsewhere_the_same_one_stays(spark):
    given = [(1, "one two three four", "en", s, 18) for s in "abcdef"] + [(2, None, None, "z", None)] * 3
    kept = set()
    for parts in (1, 2, 5):
        docs = documents(spark, given[::-1] if parts == 2 else given).repartition(parts)
        kept.add(tuple(sorted(map(repr, simhash.keep_one(docs, simhash.near_duplicates(docs)).collect()))))
    assert len(kept) == 1 and len(next(iter(kept))) == 2


def test_more_rows_take_longer_keys_and_keep_every_link():
    for rows_ in (10, 3 << 20, 1 << 40):
        masks = simhash.key_masks(rows_)
        for bits in ((0, 1, 2, 3), (0, 20, 40, 63), (5, 15, 30, 50)):
            changed = sum(1 << b for b in bits)
            assert any(not mask & changed for mask in masks)


def test_one_of_each_group_is_kept(spark):
    docs = crowded(documents(spark))
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs))
    assert kept.columns == docs.columns
    prints = [fingerprint(r[1]) for r in rows()]
    root = classes(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    want = set(zip(root, smallest([r[0] for r in rows()], root)))
    got = [r.doc_id for r in kept.collect()]
    assert sorted(got, key=repr) == sorted((i for _, i in want), key=repr)


def test_empty_tables(spark):
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs, simhash.near_duplicates(docs)).count() == 0
    assert minhash_classes.text_classes(docs).count() == 0
    assert minhash.compare_with_next(docs).count() == 0
    assert minhash.fingerprints(docs).count() == 0


def test_components_of_a_path_a_star_and_a_pair(spark):
    path = [(k + 1, k) for k in range(0, 40)]
    star = [(k, 100) for k in range(101, 160)]
    df = spark.createDataFrame([*path, *star, *star, (999, 998)], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {998: 998, 999: 998}


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("per_part", [2000, 3])
def test_minhash_with_edits_and_the_next_document(spark, per_part):
    given = documents(spark)
    # Ties of doc_id go by a hash of the text.
    tie = {r.text: r.t for r in given.selectExpr("text", "xxhash64(coalesce(text, '')) t").collect()}
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]]))
    texts = [r[1] or "" for r in order]
    want = []
    for k, text in enumerate(texts):
        after, n = texts[(k + 1) % len(texts)], len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        want.append((order[k][0], len(text), digest, jaccard(text, edited), jaccard(text, after)))
    got = minhash.compare_with_next(crowded(given), per_part=per_part).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(
        (w[:3] for w in want), key=repr
    )
    for r in got:
        near = [w for w in want if w[:3] == (r.doc_id, r.n_chars, r.edited_sha256)]
        assert min(abs(r.near_edited - w[3]) for w in near) < 0.2
        assert min(abs(r.near_next - w[4]) for w in near) < 0.2
    prints = {}
    for r in minhash.fingerprints(given).collect():
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[1] == prints[2] and len(prints[1]) == 1 and prints[3] == prints[4] == prints[5]


def test_shingle_hashes_do_not_depend_on_batches(monkeypatch):
    texts = [r[1] for r in rows()]
    whole = minhash.Hasher().signatures(pa.array(texts))
    monkeypatch.setattr(minhash, "_CHUNK", 64)
    single = [minhash.Hasher().signatures(pa.array([t], pa.string()))[0] for t in texts]
    assert np.array_equal(whole, np.stack(single))


def test_minhash_classes_equal_brute_force(spark):
    given = [r for r in rows() if r[1] is not None]
    root = classes(len(given), lambda i, j: jaccard(given[i][1], given[j][1]) >= 0.8)
    ids = [r[0] for r in given]
    got = minhash_classes.near_duplicates(crowded(documents(spark, given))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(zip(ids, smallest(ids, root)), key=repr)


def template(r, n, changes):
    """Texts that share most words of one template: many bands agree, not all are alike."""
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(r.choice(changes)):
            text[r.randrange(len(text))] = f"x{r.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def test_texts_that_share_bands_without_being_alike(spark):
    r = random.Random(8)
    texts = template(r, 60, (1, 2, 4, 6)) + template(r, 60, (4, 5, 6)) + ["lone words"] * 40 + [""] * 3
    r.shuffle(texts)
    sets = [shingles(t) for t in texts]

    def alike(i, j):
        both = len(sets[i] | sets[j])
        return len(sets[i] & sets[j]) >= 0.8 * both if both else True

    root = classes(len(texts), alike)
    docs = documents(spark, [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)])
    got = minhash_classes.near_duplicates(docs).collect()
    assert sorted(map(tuple, got)) == sorted(zip(range(len(texts)), smallest(list(range(len(texts))), root)))
    assert 10 < len(set(root)) < 150


def test_every_node_of_an_open_bucket_becomes_a_hub(spark):
    """One bucket of nodes on a line: only neighbours link, and 59 and 60 do not."""
    n = 100
    members = spark.createDataFrame([(7, 0, b) for b in range(1, n)], "key long, a long, b long")
    gap = F.abs(F.col("a") - F.col("b"))
    near = F.when((gap <= 1) & (F.greatest("a", "b") != 60), 1.0).otherwise(0.0).alias("similarity")
    roots = minhash_classes.connect(members, lambda pairs: pairs.select("a", "b", near), 0.8)
    got = {r.node: r.root for r in roots.collect()}
    assert got == {k: 0 if k < 60 else 60 for k in range(n)}


def test_a_hub_of_many_pairs_is_split(spark, monkeypatch):
    monkeypatch.setattr(minhash_classes, "PER_HUB", 3)
    texts = template(random.Random(9), 30, (1, 2)) * 2
    sets = [shingles(t) for t in texts]
    root = classes(60, lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    docs = documents(spark, [(k, t, "en", "s", 1) for k, t in enumerate(texts)])
    got = minhash_classes.near_duplicates(docs).collect()
    assert sorted(map(tuple, got)) == sorted(zip(range(60), smallest(list(range(60)), root)))
