"""Brute-force checks of the operators' kernels, without Spark."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonehour.llm.best_fit_packing import pack
from zonehour.llm.chat_format import END, TURN, escape, mask_tokens, parse, render, unescape
from zonehour.llm.ngram_quality import base_counts
from zonehour.llm.ppm_scoring import DEPTH, Trie, framed, node_codes, squeeze, unsqueeze
from zonehour.llm.simhash_dedup import list_links, simhash
from zonehour.llm.token_codes import PieceEncoder, access, access_range, encode_ids

AWKWARD = st.lists(st.sampled_from(["a", "\\", "<", "|", ">", "\n", "n", "é", TURN, END, " ", "assistant"]), max_size=20).map("".join)


@given(st.lists(st.tuples(AWKWARD, AWKWARD), max_size=5))
def test_render_is_reversible(turns):
    text, _ = render(turns)
    assert parse(text) == turns
    assert all("<|" not in escape(t) and unescape(escape(t)) == t for _, t in turns)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), AWKWARD), max_size=5), st.lists(st.integers(1, 4), max_size=200))
def test_mask_covers_exactly_the_assistant_texts(turns, sizes):
    text, spans = render(turns)
    ends = np.minimum(np.cumsum([*sizes, len(text)]), len(text))
    offsets = np.stack([np.concatenate(([0], ends[:-1])), ends], axis=1)
    mask, covered = mask_tokens(offsets, spans)
    chars = {c for a, b in covered for c in range(a, b)}
    assert chars == {c for a, b in spans for c in range(a, b)}
    assert mask.tolist() == [int(any(a < e and s < b for a, b in spans)) if s < e else 0 for s, e in offsets.tolist()]


def test_pack_takes_the_tightest_compatible_bin():
    rng = random.Random(1)
    for _ in range(100):
        lengths = sorted((rng.randint(1, 40) for _ in range(60)), reverse=True)
        sources = [rng.choice([None, *"aaabcdef"]) for _ in lengths]
        clusters = [rng.choice([None, 1, 2, 3, 4, 5]) for _ in lengths]
        bins: dict = {}
        for (b, slot, offset), n, s, c in zip(pack(lengths, sources, clusters, 40), lengths, sources, clusters):
            left = {k: 40 - sum(x[0] for x in v) for k, v in bins.items()}
            fit = [r for k, r in left.items() if r >= n and all((s is None or x[1] != s) and (c is None or x[2] != c) for x in bins[k])]
            assert left[b] == min(fit) if b in bins else not fit
            assert (slot, offset) == (len(bins.get(b, [])), 40 - left.get(b, 40))
            bins.setdefault(b, []).append((n, s, c))


@given(st.text(alphabet="ab \n#é", max_size=60))
def test_base_counts(text):
    words = text.split()
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip()]
    assert base_counts(text.encode()) == (len(words), sum(map(len, words)), text.count("#"), len(lines) - len(set(lines)), len(hit))
    assert base_counts(None) == (0,) * 5


def brute_ppm(train):
    seen: dict = {}
    for t in train:
        s = [255] * DEPTH + [*t.lower(), 255]
        for i in range(DEPTH, len(s)):
            for order in range(DEPTH + 1):
                seen.setdefault(tuple(s[i - order : i]), Counter())[s[i]] += 1

    def p(context, symbol):
        out, excluded = 1.0, set()
        for order in range(DEPTH, -1, -1):
            left = {s: n for s, n in seen.get(tuple(context[DEPTH - order :]), {}).items() if s not in excluded}
            if left:
                bottom = sum(left.values()) + len(left)
                if symbol in left:
                    return out * left[symbol] / bottom
                out *= len(left) / bottom
                excluded |= set(left)
        return out / (256 - len(excluded))

    return p


def test_ppm_equals_brute_force_and_sums_to_one():
    train = [b"the cat sat on the mat", b"Abracadabra abra", "é ñ the".encode(), b""]
    nodes = []
    for order in range(DEPTH + 1):
        codes, n = np.unique(np.concatenate([node_codes(framed(t), order) for t in train]), return_counts=True)
        nodes.append((codes, n))
    trie, p = Trie.build(nodes), brute_ppm(train)
    for t in (b"the bat", b"zq~ cadabra", b"", "ñé".encode(), b"\x00\x01ABRA"):
        s = framed(t).tolist()
        assert trie.score(t) == pytest.approx(sum(math.log10(p(s[i - DEPTH : i], s[i])) for i in range(DEPTH, len(s))))
    for context in (b"\xff" * 5, b"the c", b"zzzzz"):
        assert sum(10 ** trie.log_probs(np.frombuffer(context + bytes([v]), np.uint8))[0] for v in range(256)) == pytest.approx(1)
    assert Trie.build([(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * (DEPTH + 1)).score(b"ab") == pytest.approx(3 * math.log10(1 / 256))


@given(st.lists(st.integers(0, 2**64 - 1)))
def test_squeeze_round_trip(numbers):
    a = np.array(numbers, np.uint64)
    assert unsqueeze(squeeze(a)).tolist() == a.tolist()


def test_list_links_connect_what_all_links_connect():
    rng = random.Random(2)
    for size in (5, 600):
        values = np.array(sorted({rng.getrandbits(16) & 0x0FFF for _ in range(size)}), np.uint64)
        i, j = list_links(values, 2)
        assert (np.bitwise_count(values[i] ^ values[j]) <= 2).all()

        def groups(pairs):
            root = list(range(len(values)))

            def top(a):
                while root[a] != a:
                    a = root[a]
                return a

            for a, b in pairs:
                a, b = top(a), top(b)
                root[max(a, b)] = min(a, b)
            return [top(a) for a in range(len(values))]

        close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
        assert groups(zip(i.tolist(), j.tolist())) == groups(zip(*(x.tolist() for x in np.nonzero(np.triu(close, 1)))))
    assert simhash([], 3) == 0


@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500))
def test_token_codes_random_access(ids):
    a = np.array(ids, np.uint32)
    codes = encode_ids(a)
    assert access(*codes, np.arange(len(a))).tolist() == ids
    at = [len(ids) // 2, 0] if ids else []
    assert access(*codes, np.array(at)).tolist() == [ids[i] for i in at]
    lo = len(ids) // 3
    assert access_range(*codes, lo, len(ids)).tolist() == ids[lo:]


with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
    CODER = PieceEncoder(f.read())


PARTS = st.sampled_from([" ", "  ", "\n", "a", "é", "'s", "!", "1", "\xa0", "\x1c", "<|endoftext|>", "foo", "中", "\x85"])


@settings(deadline=None)
@given(st.lists(st.lists(PARTS, max_size=20).map("".join), min_size=1, max_size=20))
def test_piece_encoder_equals_the_library(texts):
    want = [e.ids for e in CODER.tok.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x.tolist() for x in CODER.encode(texts)] == want


def test_the_tokenizers_own_cache_is_off(monkeypatch):
    """Each piece is encoded once, so its cache only cost time."""

    class Model:
        sizes = []
        _resize_cache = sizes.append

    class Spy:
        model = Model

        @staticmethod
        def from_str(_):
            return Spy()

        def get_vocab(self):
            return {"a": 0}

    monkeypatch.setattr("tokenizers.Tokenizer", Spy)
    PieceEncoder("{}")
    assert Model.sizes == [0]


SIGNED = st.sampled_from([" ", "\n", "foo", "é", "ж", "中", "ª", "7", "_", "'", "'s", ",", ".", ")", "]", "^", "\\", "`", "\x1f", "\x1f,", "\r", "…"])


@settings(deadline=None, max_examples=300)
@given(st.lists(st.lists(SIGNED, max_size=20).map("".join), min_size=1, max_size=20))
def test_words_before_signs_equal_the_library(texts):
    want = [e.ids for e in CODER.tok.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x.tolist() for x in CODER.encode(texts)] == want
    assert [x.tolist() for x in CODER.encode(texts)] == want  # from the cache


def new_coder():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return PieceEncoder(f.read())


def test_a_word_is_encoded_once_whatever_signs_follow():
    coder = new_coder()
    text = "a qzword qzword, qzword. qzword); qzword\nqzword.\nThen qzword,"
    assert coder.encode([text])[0].tolist() == CODER.tok.encode(text, add_special_tokens=False).ids
    assert [p for p in coder.cache if "qzword" in p] == ["qzword", "qzword\nqzword"]


def test_a_failed_batch_leaves_no_empty_pieces(monkeypatch):
    coder = new_coder()
    with monkeypatch.context() as m:
        m.setattr(coder, "joined", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            coder.encode(["a word"])
    assert coder.encode(["a word"])[0].tolist() == CODER.tok.encode("a word", add_special_tokens=False).ids
