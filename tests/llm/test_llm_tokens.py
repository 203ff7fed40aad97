"""Cross-tokenizer alignment and byte-level BPE against plain versions."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from cases import DOCUMENTS, crowded, documents, rows

from tillstar.llm import alignment, merge_replay
from tillstar.llm.common import parts_of, stored
from tillstar.llm.queries import op11_token_alignment, op13_byte_bpe

ODD = [
    " lead", "  two lead", "tail ", "a  b", "a \n b", "x y 　z", "it's 'S we'll  don't\n\n\n x",
    "<|endoftext|> a<|endoftext|>", "<s> <0x41> </s>", "a▁b", "▁ x", "é\x00\x01\x1c \x1d y\x85 z",
    "日本語 テスト 😀😀 ٣٤² ½", "aaaaaaaaaaaaaaa aaaaaa", "́ á ﬁ", "\U000323b0\U000323b0 a",
    "1234567 8 9.99%%%% ...", "\t\t\ttabs \t x", " ", "\n", "zażółć gęślą jaźń " * 40,
]


@pytest.fixture(scope="module")
def given():
    ids = iter(range(100, 200))
    return rows() + [(next(ids), t, "en", "odd", len(t)) for t in ODD]


def _sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# --- byte-level BPE -------------------------------------------------------------------


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    ranks = merge_replay.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def coder():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return merge_replay.Coder(path, public_tokenizers.PATTERN, 1000)


def test_query_agrees_with_the_library(spark, tmp_path, given, tiktoken_encoding):
    documents(spark, given).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op13_byte_bpe(spark, str(tmp_path)).collect()]
    want = []
    for doc_id, text, *_ in given:
        ids = tiktoken_encoding.encode_ordinary(text or "")
        want.append((doc_id, len(ids), _sha(" ".join(map(str, ids))), _sha((text or "").encode())))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_texts_of_all_kinds_agree_with_the_library(coder, tiktoken_encoding):
    random_ = random.Random(3)
    pool = "aab eE\n\t 19.,'s 　é日😀́\x1c\x85\U000323b0"
    texts = ["".join(random_.choices(pool, k=random_.randint(0, 60))) for _ in range(3000)]
    texts += ODD + [f"a{chr(c)} {chr(c)}{chr(c)} {chr(c)}'s" for c in range(0x3100) if c % 7 == 0]
    for most in (1, 1 << 20):
        parts = [[p for some in parts_of(t, most) for p in some] for t in texts]
        assert ["".join(p) for p in parts] == texts
        got = [np.frombuffer(x, np.int32).tolist() for x in coder.encode(parts)]
        assert got == [tiktoken_encoding.encode_ordinary(t) for t in texts]


def test_replay_equals_merging_one_word_at_a_time(coder, tiktoken_encoding):
    random_ = random.Random(4)
    tokens = coder.replay.tokens
    words = [b"".join(random_.choices(tokens, k=random_.randint(0, 5))) for _ in range(4000)]
    words += [bytes(random_.choices(b"ab ", k=random_.randint(0, 40))) for _ in range(2000)]
    want = [tiktoken_encoding._core_bpe.encode_single_piece(w) if w else [] for w in words]
    assert [np.frombuffer(x, np.int32).tolist() for x in coder.replay.replay(words)] == want
    assert [np.frombuffer(coder.replay._alone(w), np.int32).tolist() for w in words] == want


def test_a_sweep_that_brings_up_a_lower_rank_is_done_again():
    ranks = {bytes([b]): b for b in range(256)}
    # "cd" goes first; "bcd", which it makes, ranks below it, and so does "cda".
    ranks |= {b"bcd": 256, b"cd": 257, b"cda": 258, b"dab": 259}
    replay = merge_replay.MergeReplay(ranks)
    for word in (b"bcdabcd", b"cdabcdab", b"abcd", b"cdcda"):
        assert replay.replay([word, b"x" + word])[0] == replay._alone(word)
        assert replay.replay([b"cd", word])[1] == replay._alone(word)


def test_a_very_long_word_takes_linear_time(coder, tiktoken_encoding):
    import time

    start = time.time()
    assert len(coder.replay.replay([b"x" * 1_000_000])[0]) == 4 * 125_000
    assert time.time() - start < 20


def test_ids_come_back_as_the_text(spark, given):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = crowded(documents(spark, given)).selectExpr("*", "'own ids' AS ids")
    coded = merge_replay.encode(docs, ranks, public_tokenizers.PATTERN)
    assert coded.columns == docs.columns and dict(coded.dtypes)["ids"] == "array<int>"
    for r in merge_replay.decode(coded, ranks).collect():
        assert bytes(r.decoded).decode() == (r.text or "") and r.part == "own part"
    empty = merge_replay.decode(
        merge_replay.encode(documents(spark, []), ranks, public_tokenizers.PATTERN), ranks
    )
    assert empty.count() == 0


# --- alignment ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def plain():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a_bytes = alignment.byte_level_tokens(a.get_vocab())

    def ranges(ids, of):
        out, at = [], 0
        for k in ids:
            out.append((at, at + len(of(k))))
            at += len(of(k))
        return out

    def one(text):
        """Ids, groups and links of a whole text, by comparing all byte ranges."""
        first = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        second = b.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        piece = lambda k: alignment.piece_bytes(b.id_to_piece(k))
        if not text or b"".join(a_bytes[k] for k in first) != raw or b"".join(map(piece, second)) != raw:
            return [], [], [], []
        x, y = ranges(first, lambda k: a_bytes[k]), ranges(second, piece)
        ends = sorted({e for _, e in x} & {e for _, e in y})
        groups, low = [], 0
        for end in ends:
            groups.append(
                ",".join(str(k) for k, (_, e) in zip(first, x) if low < e <= end)
                + "|"
                + ",".join(str(k) for k, (_, e) in zip(second, y) if low < e <= end)
            )
            low = end
        links = [
            (k, m)
            for k, (s, e) in zip(first, x)
            for m, (t, f) in zip(second, y)
            if max(s, t) < min(e, f)
        ]
        return first, second, groups, links

    return one


def _expected(plain, given):
    found = [(doc_id, *plain(text)) for doc_id, text, *_ in given]
    held = {}
    for *_, links in found:
        for pair in set(links):
            held[pair] = held.get(pair, 0) + 1
    top = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    return [
        (
            doc_id, len(a), len(b), len(groups), len(links),
            sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links),
            _sha(";".join(groups)) if a else "",
        )
        for doc_id, a, b, groups, links in found
    ]


def _shorter(given):
    """All byte ranges are compared: the very long text only in part."""
    return [(d, t if t is None else t[:6000], *rest) for d, t, *rest in given]


def test_query_agrees_with_comparing_all_byte_ranges(spark, tmp_path, given, plain):
    given = _shorter(given)
    documents(spark, given).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op11_token_alignment(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(_expected(plain, given), key=repr)


def test_blocks_and_memory_do_not_change_the_result(spark, given, plain):
    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    given = _shorter(given)
    docs = crowded(documents(spark, given)).selectExpr("*", "'own lot' AS lot", "1 AS pairs")
    aligned = stored(alignment.align(docs, *paths, block=2000, known_parts=5), "test")
    assert aligned.select("lot").distinct().count() > 5
    out = alignment.count_links(aligned)
    assert out.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum",
    ]
    want = sorted(((*r[:5], *r[5:7]) for r in _expected(plain, given)), key=repr)
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) for r in out.collect()]
    assert sorted(got, key=repr) == want
    texts = {r.doc_id: r.groups for r in out.collect() if r.doc_id == 8}
    assert texts[8] == ";".join(plain("one two three")[2])
    counts = {(r.a_id, r.b_id): r.n for r in alignment.pair_counts(aligned).collect()}
    held = {}
    for _, text, *_ in given:
        for pair in set(plain(text)[3]):
            held[pair] = held.get(pair, 0) + 1
    assert counts == held


def test_a_worker_remembers_few_bytes_for_few_parts(plain):
    import tracemalloc

    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    random_ = random.Random(5)
    words = ["".join(random_.choices("etaoin", k=8)) for _ in range(60_000)]
    texts = [" ".join(words[k : k + 100]) for k in range(0, len(words), 100)]
    aligner = alignment.Aligner(*paths, 1000)
    tracemalloc.start()
    block = alignment.Block(aligner, texts)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 350 * len(words)
    again = alignment.Block(aligner, texts[:1] + ["x y"])
    assert len(aligner.number) < 1000 + 100 + 10
    assert again.groups(0, 2) == [";".join(plain(t)[2]) for t in (texts[0], "x y")]
    del block


def test_groups_and_links_of_a_small_case():
    assert alignment.common_ends([2, 5, 6], [1, 5, 6]) == ([2, 3], [2, 3])
    i, j = alignment.links(np.array([2, 5, 6]), np.array([1, 5, 6]))
    assert list(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2)]


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    assert op11_token_alignment(spark, str(tmp_path)).count() == 0
    assert op13_byte_bpe(spark, str(tmp_path)).count() == 0
