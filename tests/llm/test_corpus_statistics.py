"""Phrase mining, divergence audit and first-fit packing against brute-force versions, and on awkward rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sigmill.llm import divergence, ffd, phrases, tokens
from sigmill.llm import queries as llm

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, rank int, part string, N string"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty, blank and very long texts, repeated rows, other scripts, control characters, columns with clashing names."""
    texts = [None, "", " \n\t ", "one two", "one two", "The cat. the CAT; the\tcat  sat, the cat sat on", "\x01a \x1fb a\x01 \u00e9\u00c9 \u65e5\u672c \U0001f600 x", "A b " * 30_000, "ab" * 50_000, "a\x0bb\x0cc\rd\x1ce f", "x\u00a0y x\u00a0y \u0130"]
    rows = [(k if k != 4 else 3, t, (None, "en", "und", "de", "")[k % 5], (None, "", "a", "b")[k % 4], k, "p", "N") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(None, "the cat sat", "en", "b", 0, "p", "N"), *[(50, "the cat sat on a mat", "en", "b", 0, "p", "N")] * 3], SCHEMA)


def phrases_by_hand(rows, min_count, max_n, covered, top):
    f, n, out = defaultdict(Counter), Counter(), []
    for text, lang in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(w)
            for m in range(1, max_n + 1):
                f["und" if lang is None else lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        gone = {q[i : i + m] for q, b in found.items() for m in range(2, len(q)) for i in range(len(q) - m + 1) if 100 * b >= covered * found.get(q[i : i + m], 1 << 60)}
        scored = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("covered", [100, 60])
def test_phrases_by_brute_force(spark, awkward, covered):
    rows = [(r["text"], r["lang"]) for r in awkward.collect()]
    got = phrases.collocations(awkward, min_count=2, covered=covered, top=12, block=50)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = phrases_by_hand(rows, 2, 5, covered, 12)
    assert sorted(map(tuple, got.collect())) == expected and len({r[0] for r in expected}) >= 2


def test_phrases_of_documents_do_not_depend_on_ranges(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected = phrases_by_hand([(r["text"], r["lang"]) for r in docs.collect()], 20, 5, 100, 300)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for partitions in ("1", "61"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = phrases.collocations(docs, min_count=20, top=300, block=3000).collect()
            assert sorted(map(tuple, got)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_one_stack_counts_prefixes_of_any_batches():
    rng = random.Random(5)
    rows = Counter(b" ".join(rng.choices([b"a", b"b", b"a\x01", b"c\xc3\xa9"], k=rng.randint(1, 4))) + b" " for _ in range(3000))
    want = Counter()
    for s, n in rows.items():
        w = s.split(b" ")[:-1]
        for k in range(len(w) + 1):
            want[b" ".join(w[:k])] += n
    ordered = sorted(rows.items(), reverse=True)
    for most in (1, 7, 10_000):
        for ranges in (1, 9):
            got = Counter()
            for a in range(0, len(ordered), -(-len(ordered) // ranges)):
                stack, mine = phrases.PrefixStack("en", 4, 40), ordered[a : a - (-len(ordered) // ranges)]
                for k in range(0, len(mine), most):
                    part = mine[k : k + most]
                    for _, p, n in stack.add(pa.array([x[0] for x in part], pa.binary()), np.array([x[1] for x in part])):
                        got[p] += n
                for _, p, n in stack.close():
                    got[p] += n
            assert {p: n for p, n in got.items() if n >= 40} == {p: n for p, n in want.items() if n >= 40}


def test_ranges_of_sorted_suffixes():
    values = [b"d ", b"c x ", b"c ", b"b y ", b"b ", b"a "]
    for cuts in ([], [b"c "], [b"z ", b"c ", b"bb "], [b"b ", b"a ", b"0 "]):
        got = phrases.ranges_of(pa.array(values, pa.binary()), cuts)
        assert got.tolist() == [sum(v <= c for c in cuts) for v in values]
    assert phrases.ranges_of(pa.array([], pa.binary()), [b"c "]).tolist() == []


def test_long_texts_are_cut_between_pieces():
    text = b"ab cd. ef, gh\nij kl" * 50
    got = list(phrases.parts(text, 30))
    assert len(got) > 20 and [w for p in got for w in re.split(rb"[.,\n]", p)] == re.split(rb"[.,\n]", text)
    assert list(phrases.parts(b"x" * 100, 30)) == [b"x" * 100] and list(phrases.parts(b"", 30)) == [b""]


def test_scores_beyond_64_bits(spark):
    a, n, left, right = 3_000_000_019, 9_000_000_000_000_037, 70_000_000_003, 90_000_000_001
    got = spark.sql(f"select (1000 * cast({a} as decimal(20,0)) * cast({n} as decimal(20,0))) div (cast({left} as decimal(20,0)) * cast({right} as decimal(20,0))) as s").first()[0]
    assert got == 1000 * a * n // (left * right)


def audit_by_hand(rows, min_docs, top):
    groups, own, in_docs = set(), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        key = (lang or "", source or "")
        groups.add(key)
        own[key].update(w)
        in_docs[key[0]].update(set(w))
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in in_docs[lang].items() if n >= min_docs)
        sources = [s for g, s in groups if g == lang]
        p = lambda count: {t: 1 + 10**9 * (count[t] + 2) // (sum(count[x] for x in kept) + 2 * len(kept)) for t in kept}
        ps = {s: p(own[lang, s]) for s in sources}
        q = p(sum((own[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = sorted((-sum(f(ps[s][t], ps[o][t]) for t in kept), o) for o in sources if o != s)
            term = sorted((-f(ps[s][t], q[t]), t.encode()) for t in kept if own[lang, s][t] and ps[s][t] > q[t])[:top]
            out += [(lang, s, "pair", o, -v, r) for r, (v, o) in enumerate(pair, 1)] + [(lang, s, "term", t.decode(), -v, r) for r, (v, t) in enumerate(term, 1)]
    return sorted(out)


@pytest.mark.parametrize("min_docs", [1, 2, 99])
def test_audit_by_brute_force(spark, awkward, min_docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in awkward.collect()]
    got = divergence.audit(awkward, min_docs=min_docs, top_terms=3)
    assert sorted(map(tuple, got.collect())) == audit_by_hand(rows, min_docs, 3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_audit_in_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "ROWS", 3)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert sorted(map(tuple, divergence.audit(docs, min_docs=3, block=3, vectors=50).collect())) == audit_by_hand(rows, 3, 10)


def test_first_fit_by_a_tournament():
    rng = random.Random(3)
    for _ in range(50):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(0, 80))]
        room, want = [], {}
        for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            at = next((j for j, r in enumerate(room) if r >= sizes[k]), len(room))
            room = [*room, 100] if at == len(room) else room
            room[at] -= sizes[k]
            want[k] = at
        got = {k: j for j, b in enumerate(ffd.first_fit_decreasing(sizes, 100)) for k in b}
        assert got == want


def check_packing(rows, texts, capacity):
    """All ids once, in order, within sequences without gaps and without padding."""
    library = Tokenizer.from_file(ffd.default_tokenizer())
    ids = [np.array([*e.ids, 1], "<u4") for e in library.encode_batch([t or "" for _, t in texts], add_special_tokens=False)]
    want = Counter((d, len(x), zlib.crc32(x.tobytes())) for (d, _), x in zip(texts, ids, strict=True))
    assert sum(r["length"] for r in rows) == sum(map(len, ids))
    by_sequence, parts = defaultdict(list), Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end == capacity or end & end - 1 == 0
    for (d, _), x in zip(texts, ids, strict=True):  # rows of a doc_id may share pieces only if their ids agree
        starts = sorted((a, n) for i, a, n, c in parts if i == d and c == zlib.crc32(x[a : a + n].tobytes()))
        reach = {0}
        for a, n in starts:
            if a in reach:
                reach.add(a + n)
        assert len(x) in reach
    whole = Counter()
    for r in rows:
        whole[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert whole == Counter({k: n for k, n in sum((Counter({(d, n): n * c}) for (d, n, _), c in want.items()), Counter()).items()})


def test_packing_without_padding(spark, awkward):
    texts = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    check_packing(ffd.pack(awkward).collect(), texts, 2048)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for groups in (4_000_000, 20_000):
        rows = llm.op13_ffd_packing(spark, SMALL).collect() if groups == 4_000_000 else ffd.pack(docs, group_tokens=groups).collect()
        check_packing(rows, texts, 2048)


def test_words_between_spaces_give_the_library_s_ids():
    library, encoder = Tokenizer.from_file(ffd.default_tokenizer()), tokens.Encoder(ffd.default_tokenizer(), 30)
    texts = ["don't 'tis x's'll 've", "a\u0301? e\u0302\u0323!! x\u0328?", "\u0391\u03a3. \u03a3\u0391\u03a3 \u0130I\x1cb a\x85b\xa0c\u3000d", "<|endoftext|> hi", "<|EndOfText|> hi", "12345, 1a2b!!! '' \" '", "\u65e5\u672c\u8a9e\u3002\u30c6\u30b9\u30c8!", "x\u200bz\xad?  \ufeff a", "a" * 5000 + "!", "ab'..'s", "", " ", None]
    assert encoder.spaceless and not encoder.by_words
    for _ in range(2):
        assert [list(x) for x in encoder.documents(texts * 20, 7)] == [[*library.encode(t or "", add_special_tokens=False).ids, 7] for t in texts * 20]
