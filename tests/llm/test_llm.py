"""Operators of tidemark.llm against brute-force versions on small tables with nulls, ties, repeats, long texts and clashing names."""

import base64
import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, components, forest, gsaca, language, near_dup, positional, substring, suffixes, token_counts, toxicity, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, seg long, bucket string"  # the last two clash with names used inside
WS = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed=0, n=40):
    """Random texts of few words with shared passages, copies, nulls, empties and a long text."""
    rng = random.Random(seed)
    words = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(60)]
    passages = [" ".join(rng.choices(words, k=rng.randint(15, 60))) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(rng.randint(1, 4))]
        rows.append((i * 3, rng.choice(["  ", "\n", "\t "]).join(parts)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (204, "  \n "), (None, rows[5][1]), (205, "a b"), (206, "a b"), (207, "aaaa " * 3000), (208, "aaaa " * 40)]
    rows += [rows[7], rows[7]]  # repeated rows
    near = rows[11][1].split()
    for i in range(6):
        w = (near * 3)[:150]
        w[10 * i] = f"edit{i}"
        rows.append((300 + i, " ".join(w)))
    return [(d, t, 1, "x") for d, t in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


BIG = 2**63 - 1


def brute_windows(rows, width, units):
    """For each row the covered flags: windows that also begin earlier (smaller id, or same id and smaller place)."""
    first = {}
    items = [(BIG if d is None else d, units(t)) for d, t, *_ in rows]
    for d, u in items:
        for i in range(len(u) - width + 1):
            key = tuple(u[i : i + width])
            first[key] = min(first.get(key, (d, i)), (d, i))
    return items, first


def test_substring_dedup(spark):
    rows = corpus()
    got = substring.dedup_substrings(frame(spark, rows), carry=["doc_id", "seg", "bucket"]).collect()
    items, first = brute_windows(rows, 20, lambda t: WS.findall(t or ""))
    want = []
    for (d, w), (orig, *_) in zip(items, rows):
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] < (d, i):
                gone[i : i + 20] = [True] * 20
        want.append((str(orig), len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == sorted(want)
    assert all(r.seg == 1 and r.bucket == "x" for r in got)
    assert substring.dedup_substrings(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        substring.dedup_substrings(empty(spark), width=13)


def test_cover_is_a_difference_cover():
    for i, j in itertools.product(range(13), repeat=2):
        assert any((i + k) % 13 in substring.COVER and (j + k) % 13 in substring.COVER for k in range(13))


@pytest.mark.parametrize("hot", [suffixes.HOT, 1, 3])
def test_suffix_dedup(spark, hot):
    rows = corpus(1) + [(500 + i, f"left{i * 17} " + "common passage of more than fifty bytes, held by many documents" + f" right{i * 31}", 1, "x") for i in range(12)]
    got = suffixes.dedup_bytes(frame(spark, rows), carry=["doc_id", "bucket"], hot=hot).collect()
    least = {}
    items = [(BIG if d is None else d, (t or "").encode()) for d, t, *_ in rows]
    for d, b in items:
        for i in range(len(b) - 49):
            least[b[i : i + 50]] = min(least.get(b[i : i + 50], d), d)
    want = []
    for (d, b), (orig, *_) in zip(items, rows):
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if least[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        want.append((str(orig), len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(x for x, g in zip(b, gone) if not g)))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got) == sorted(want)
    assert suffixes.dedup_bytes(empty(spark)).count() == 0


def test_suffix_arrays_side_by_side():
    rng = random.Random(4)
    for n in range(120):
        texts = [bytes(97 + rng.randrange(1 + n % 4) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 12))]
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        want = [int(a) + i for a, t in zip(first, texts) for i in sorted(range(len(t)), key=lambda i: t[i:])]
        assert gsaca.suffix_arrays(np.frombuffer(b"".join(texts), np.uint8), first).tolist() == want


def test_every_removed_byte_comes_from_a_suffix_array(monkeypatch):
    """With arrays that are empty nothing is found, so no other path removes a byte; copies and edited texts alike."""
    passage = b"the same passage of well over fifty bytes in each of them, to the letter"
    texts = [b"one " + passage, b"one " + passage, b"another " + passage[:60]]
    column = lambda values: [b"".join(values)]
    number = lambda values, kind: [np.array(values, kind).tobytes()]
    table = pa.table({"bucket": [0], "seg": [3], "key": number([7] * 3, np.uint64), "text": number([1, 1, 2], np.uint64), "at": number([10, 10, 90], np.int64), "id": number([4, 5, 6], np.int64), "size": number([len(t) for t in texts], np.int32), "bytes": column(texts)}, schema=suffixes.TEXTS)
    got = suffixes._sort_texts(50)(table)
    rows = sorted(zip(*(suffixes.S.gather(got, c, t).tolist() for c, t in (("at", np.int64), ("id", np.int64), ("lo", np.int32), ("hi", np.int32)))))
    assert rows == [(10, 5, 0, len(texts[0]) - 49), (90, 6, 7, 8 + 11)]  # the space before the passage is alike too
    for name in ("suffix_array", "suffix_arrays"):
        monkeypatch.setattr(suffixes, name, lambda *_: np.zeros(0, np.int64))
    assert not suffixes._sort_texts(50)(table).num_rows


@pytest.mark.parametrize("crowd", [0, suffixes.CROWD, 1 << 40])
def test_of_a_passage_in_many_surroundings_less_is_sorted(monkeypatch, crowd):
    """The holders are those of a search of all strings, and of a crowded key only what is found twice is sorted."""
    rng = random.Random(6)
    passage = b"a line that very many documents have, each among words of its own; "
    around = lambda: bytes(97 + rng.randrange(26) for _ in range(rng.randint(0, 40)))
    texts = [t for t in (around() + passage[: rng.choice((30, 52, len(passage)))] + around() for _ in range(400)) if len(t) >= 50] + [b"en " * 40, b"n en " * 30]
    size, ids = np.array([len(t) for t in texts]), np.array(rng.sample(range(9999), len(texts)))
    copied = np.array([rng.random() < 0.1 for _ in texts])
    least = {}
    for t, d in zip(texts, ids.tolist()):
        for i in range(len(t) - 49):
            least[t[i : i + 50]] = min(least.get(t[i : i + 50], d), d)
    want = [least[t[i : i + 50]] for t in texts for i in range(len(t) - 49)]
    own, twice = np.repeat(ids, size - 49), np.repeat(copied, size - 49)
    sorted_bytes = []
    for name in ("suffix_array", "suffix_arrays"):
        monkeypatch.setattr(suffixes, name, lambda text, *more, run=getattr(gsaca, name): sorted_bytes.append(len(text)) or run(text, *more))
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    got = suffixes.holders(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, size, np.full(len(texts), 7, np.uint64), ids, copied, 50)
    asked = twice | (np.array(want) < own)  # what is removed anywhere; all else may be left out
    assert got[asked].tolist() == np.array(want)[asked].tolist() and (got[~asked] >= own[~asked]).all()
    assert crowd == 1 << 40 or sum(sorted_bytes) < size.sum() * 2 / 3


def test_suffix_array():
    rng = random.Random(3)
    for n in range(300):
        s = bytes(97 + rng.randrange(1 + n % 4) for _ in range(rng.randint(0, 50)))
        assert gsaca.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def shingles(text):
    w = WS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_near_duplicates(spark):
    rng = random.Random(5)
    rows = corpus(2)
    base = [f"t{rng.randrange(10**6)}" for _ in range(120)]
    for i in range(60):  # a group of near copies, some too far from all others
        w = list(base)
        for p in rng.sample(range(120), i % 7):
            w[p] = f"e{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(w), 1, "x"))
    sets = {}
    for d, t, *_ in rows:
        sets[d] = shingles(t)
    ids = [d for d in sets if d is not None and sets[d]]
    parent = {d: d for d in ids}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in itertools.combinations(ids, 2):
        k = len(sets[a] & sets[b])
        if 100 * k >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    want = sorted(str((d, len(sets[d]), root(d) if d in parent else d, d is None or (root(d) if d in parent else d) == d)) for d, *_ in rows)
    got = near_dup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in got) == want
    kept = near_dup.deduplicate(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "seg", "bucket"] and kept.count() == sum("True" in w for w in want)
    assert near_dup.near_duplicates(empty(spark)).count() == 0


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(1, 2**63, 300).astype(np.uint64)
    a, b = np.sort(pool[:200]), np.sort(pool[100:])
    s = near_dup.signatures(np.concatenate([a, b]), np.array([0, 200, 400]))
    assert abs((s[0] == s[1]).mean() - 1 / 3) < 0.15 and np.isfinite(s).all()
    assert np.isinf(near_dup.signatures(np.zeros(0, np.uint64), np.array([0, 0]))).all()
    one = near_dup.signatures(a[:1], np.array([0, 1]))[0]
    assert sorted(np.floor(one)) == list(range(near_dup.SLOTS))  # one element fills every slot, a round each


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (200, 200), (102, 100)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(t):
    return WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


@pytest.mark.parametrize("block", [positional.BLOCK_WORDS, 5])
def test_decontamination(spark, block, monkeypatch):
    monkeypatch.setattr(positional, "BLOCK_WORDS", block)
    rows = corpus(4)
    items = [(1, " ".join(rows[0][1].split()[:30])), (2, "A  b"), (3, None), (4, ""), (5, rows[9][1]), (None, "w1 w2"), (10, "a b"), (2, "a b")]
    got = positional.decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = []
    for d, t, *_ in rows:
        w = bench_words(t)
        hit, own = [False] * len(w), set()
        for item, text in items:
            iw = bench_words(text)
            n = min(13, len(iw))
            windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if iw else ()
            for i in range(len(w) - n + 1) if windows else ():
                if tuple(w[i : i + n]) in windows:
                    hit[i : i + n] = [True] * n
                    own |= {item} - {None}
        want.append(str((d, len(w), sum(hit), sorted(own), sum(hit) > 0 and 20 * sum(hit) >= len(w))))
    assert sorted(str((r.id, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated)) for r in got) == sorted(want)
    assert positional.decontaminate(empty(spark), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert positional.decontaminate(frame(spark, rows), spark.createDataFrame([], "item_id long, text string")).where("n_hit > 0").count() == 0


def test_proximity(spark):
    index = positional.build_index(spark.createDataFrame([(1, "alpha x x beta"), (2, "alpha x x x x beta"), (3, "beta alpha"), (4, "alpha"), (5, "beta")], "doc_id long, text string"))
    got = positional.proximity(index, ["Alpha beta", "missing"], within=3).collect()
    assert sorted((r.id, r.phrase) for r in got) == [(1, 0), (3, 0)]


def test_byte_bpe_matches_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(6)
    letters = "'strevlmdx 9 \n\t\r 　éñÉ½²٣!?.,’\"中文😀́-S"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(500)] + [None, "", "ab" * 4000, "<|endoftext|>", " " * 50, "it's we'll they're 'S"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in byte_bpe.digests(docs, path).collect()}
    out = {r.doc_id: r for r in byte_bpe.encode(docs, path).collect()}
    vocab = byte_bpe.vocabulary(path)
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert out[i].ids == ids, t
        assert got[i].n_tokens == len(ids) and got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert [(t or "").encode()[o : o + len(vocab.bytes[x])] for o, x in zip(out[i].offsets, ids)] == [vocab.bytes[x] for x in ids]
    assert byte_bpe.digests(empty(spark), path).count() == 0


def test_token_counts_match_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tk = token_counts.tokenizer(path)
    rng = random.Random(7)
    scripts = ["abcdefgh  \nÉé\u0301'st123!?<|endoftext|> ", "中文字漢語的是不了人", "'s't're!?.,''", "éêñ\u0301\u0302한국어\u1100\u1161\u11a8", "İiςσΣABC", "12 34'd'll", "🙂👩\u200d ️x"]
    for n in range(400):
        letters = "".join(rng.sample(scripts, 2)) if n % 2 else rng.choice(scripts)
        t = "".join(rng.choices(letters, k=rng.randint(0, 700)))
        t = t + "<|endoftext|>" + t if n % 7 == 0 else t
        want = len(tk.encode(t, add_special_tokens=False).ids)
        assert all(token_counts.count_long(tk, t, *size) == want for size in ((50, 8), (120, 30), (64, 40))), t
    rows = corpus(8) + [(900, "<|endoftext|> wörd " * 9000, 1, "x"), (901, "漢語" * 20000, 1, "x"), (None, "a b", 1, "x")]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):  # the second one isn't spliced
        tk = token_counts.tokenizer(public_tokenizers.path(name))
        assert token_counts.fits(public_tokenizers.path(name)) == (name == "word_bpe_49k.json")
        odd = spark.createDataFrame([(d, t, 5, "n") for d, t, *_ in rows], "doc_id long, text string, n_tokens int, over_limit string")
        got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(odd, public_tokenizers.path(name)).collect())
        counts = [len(tk.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in rows]
        assert got == sorted((str(d), len((t or "").encode()), n, n > 2048) for (d, t, *_), n in zip(rows, counts))
    assert token_counts.token_counts(empty(spark), path).count() == 0


def test_token_counts_take_linear_time():
    """A text without white space is spliced inside its one word: no chunk is joined to another."""
    tk = token_counts.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    text, sizes = "".join(random.Random(1).choices("中文字漢語的是不了人", k=100_000)), []
    plain = token_counts._encode
    try:
        token_counts._encode = lambda tk, t, a, b: sizes.append(b - a) or plain(tk, t, a, b)
        count = token_counts.count_long(tk, text)
    finally:
        token_counts._encode = plain
    assert count == len(tk.encode(text, add_special_tokens=False).ids)
    assert max(sizes) <= 2 * token_counts.CHUNK and sum(sizes) <= 1.2 * len(text)


def test_warc_round_trip(spark, tmp_path):
    rng = random.Random(9)
    long = "".join(rng.choices("aé\r\n WARC/1.1", k=5000))
    rows = [(1, "http://a", long), (2, "http://b", long), (3, "u\r\nX: y", "é"), (4, None, None), (5, "e", ""), (6, "w", "WARC/1.1\r\n\r\n"), (3, "again", "é"), (None, "n", long), (None, "m", "only here"), (7, "h", "x\n\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"), size=64)
    got = warc.read_records(spark, str(tmp_path / "w")).collect()
    want = []
    for p, _, h in rows:
        same = [x for x, _, y in rows if (y or "") == (h or "") and x is not None]
        first = min(same, default=None)
        b = (h or "").encode()
        want.append(str((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if p == first else "revisit", None if p == first else first)))
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == sorted(want)
    assert {r.url for r in got if r.page_id == 3} == {"u%0D%0AX: y", "again"}
    # the chunk table: no piece is longer than asked for, and together they are the payload
    pieces = {}
    for r in warc.chunk_table(pages, size=64).collect():
        assert len(r.chunk) <= 64 and (r.digest is not None) == (r.chunk_no == r.n_chunks - 1)
        pieces.setdefault(r.record, {})[r.chunk_no] = bytes(r.chunk)
    assert sorted(b"".join(c[i] for i in range(len(c))) for c in pieces.values()) == sorted((h or "").encode() for *_, h in rows)
    segments = warc.read_segments(spark, str(tmp_path / "w")).where("segment is not null").collect()
    assert segments and all(len(r.chunk) <= 64 for r in segments)
    warc.write_archives(pages.where("false"), str(tmp_path / "e"))
    assert warc.read_records(spark, str(tmp_path / "e")).count() == 0
    odd = pages.selectExpr("page_id", "url", "html", "1 as record", "'x' as digest", "2 as chunk_no")
    warc.write_archives(odd, str(tmp_path / "o"), size=64)
    assert sorted(map(str, warc.read_records(spark, str(tmp_path / "o")).collect())) == sorted(map(str, got))
    with pytest.raises(ValueError):
        list(warc.records([b"x"]))
    # blocks that end anywhere, as lines of a stream do
    members = b"".join(f"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {n}\r\n\r\n".encode() + b"x" * n + b"\r\n\r\n" for n in (3, 0, 5))
    for step in (1, 7, 1000):
        blocks = (members[i : i + step] for i in range(0, len(members), step))
        assert [b"".join(body) for _, body in warc.records(blocks)] == [b"xxx", b"", b"xxxxx"]


def test_warc_finds_a_missing_segment(spark):
    row = {"origin": "a", "page_id": 1, "url": None, "record_type": "response", "refers_to": None, "carried": "", "length": 2, "n": None, "digest": None, "chunk": b"x"}
    for numbers in ((2,), (1, 3), (1, 1)):
        batch = pa.RecordBatch.from_pylist([row | {"segment": n} for n in numbers], schema=warc._SEGMENTS)
        with pytest.raises(ValueError):
            list(warc._assemble(iter([batch])))


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((3000, 16)).astype(np.float32)
    v[100:400] = v[7]  # copies
    rows = [(int(i), x.tolist()) for i, x in enumerate(v)] + [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [None] + [1.0] * 15), (5080, [1.0])]
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in forest.search(frame_, "vec_id % 20 = 0", leaf_rows=200).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 20))
    d, hits = v.astype(float), 0
    for q, found in got.items():
        s = (d @ d[q]).round(12)
        order = [i for i in np.lexsort([np.arange(3000), -s]) if i != q][:20]
        assert len(found) == 20 and q not in [i for i, _ in found]
        assert np.allclose([x for _, x in found], d[[i for i, _ in found]] @ d[q])
        hits += len(set(order) & {i for i, _ in found})
    assert hits / (20 * len(got)) >= 0.9
    # leaves dealt over a grid of vectors and queries give the same; columns named like those used inside don't matter
    odd = frame_.selectExpr("vec_id", "embedding", "1 as id", "'x' as vector", "2 as leaf", "3 as q")
    dealt = sorted(map(tuple, forest.search(odd, "vec_id % 20 = 0", leaf_rows=200, sample=64, leaf_queries=20).collect()))
    assert dealt == sorted(map(tuple, forest.search(frame_, "vec_id % 20 = 0", leaf_rows=2000, sample=64).collect()))
    few = forest.search(spark.createDataFrame(rows[:5], "vec_id long, embedding array<float>"), "vec_id % 20 = 0").collect()
    assert [r.rank for r in few] == [1, 2, 3, 4]
    assert forest.search(frame_.where("false"), "true").count() == 0


def test_language(spark):
    rng = random.Random(10)
    syllables = {"aa": ["ka", "to", "ri", "mu"], "bb": ["sch", "ung", "eit", "ver"], "cc": ["ção", "lho", "nha", "eis"]}
    rows = [(i, " ".join("".join(rng.choices(syllables[l], k=3)) for _ in range(30)), l) for i, l in enumerate(rng.choices(list(syllables), k=300))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs.where("doc_id % 5 <> 0"))
    got = language.identify(docs.where("doc_id % 5 = 0"), model, carry=["doc_id", "lang"]).collect()
    assert all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in got) and len(got) == 60
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "qqqq")], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in language.identify(odd, model).orderBy("doc_id").collect()][:3] == [("und", 0.0)] * 3
    none = language.learn(docs.where("false"))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}


def test_more_languages_than_bits_of_a_word(spark):
    rng = random.Random(15)
    words = {f"l{i:03d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)] for i in range(70)}
    rows = [(i * 20 + j, " ".join(rng.choices(words[lang], k=20)), lang) for i, lang in enumerate(words) for j in range(12 if i % 10 else 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs)
    assert model.languages == sorted(words) and model.table.shape == (language.SLOTS, 2)
    got = language.identify(docs, model, carry=["lang"]).collect()
    assert all(r.lang_pred == r.lang for r in got)


def test_bloom_masks_name_every_language_of_a_gram():
    table = np.zeros(language.SLOTS, np.uint64)
    keys = language.grams(np.frombuffer(b"abcdefgh", np.uint8), 3)
    for bit, part in enumerate((keys[:4], keys[2:])):
        for at in language.slots(part):
            table[at] |= np.uint64(1 << bit)
    total, found = language.Model(["x", "y"], table).counts(np.frombuffer(b"abcdefgh", np.uint8), np.array([0, 8]))
    assert found[0, 0] >= 4 and found[0, 1] >= 4 and total[0] == 7 + 6 + 5


def toxic_corpus(spark, n=600):
    rng = random.Random(11)
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        w = rng.choices(plain, k=60)
        if bad:
            w[rng.randrange(60)] = rng.choice(["vilescum", "nastyrot", "vilescums"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark):
    docs, labels = toxic_corpus(spark)
    index = toxicity.learn(docs.where("doc_id % 5 <> 0"), labels.where("doc_id % 5 <> 0"))
    got = toxicity.score(docs.where("doc_id % 5 = 0"), index).join(labels, "doc_id").collect()
    assert all(r.predicted == r.toxic for r in got)
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == (r.predicted == 1) for r in got)
    assert all(r.neighbours for r in got if r.toxic)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "vilescum " * 9000)], "doc_id long, text string")
    assert [r.predicted for r in toxicity.score(odd, index).orderBy("doc_id").collect()] == [0, 0, 1]
    none = toxicity.learn(docs.where("false"), labels)
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}


def test_block_max_search_is_exact(spark):
    docs, labels = toxic_corpus(spark)
    index = toxicity.learn(docs, labels)
    for t, w in index.vectors[:80]:
        place, sims = index.nearest(t, w)
        dense = np.zeros(len(index.terms))
        dense[t] = w
        all_ = np.array([(dense[a] * b).sum() for a, b in index.vectors])
        order = np.lexsort([np.arange(len(all_)), -np.round(all_, 12)])[: toxicity.NEAREST]
        order = order[all_[order] > 0]
        assert place.tolist() == order.tolist() and np.allclose(sims, all_[order])


def test_toxic_words_of_few_examples_count(spark):
    """Every toxic word occurs in three examples only, and one copied passage in one."""
    rng = random.Random(13)
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rare = ["".join(rng.choices("bcdfghjklmnpqrstvxz", k=9)) for _ in range(101)]
    rows = [(i, " ".join(rng.choices(plain, k=40)), 0) for i in range(1000)]
    for i in range(300):
        w = rng.choices(plain, k=40)
        w[rng.randrange(40)] = rare[i % 100]
        rows.append((1000 + i, " ".join(w), 1))
    passage = " ".join([*rng.choices(plain, k=20), *[rare[100]] * 3])
    rows += [(2000 + i, passage, 1) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    index = toxicity.learn(frame.drop("toxic"), frame.drop("text"))
    asked = [" ".join([*rng.choices(plain, k=39), w]) for w in rare[:100]] + [passage] * 50 + [" ".join(rng.choices(plain, k=40)) for _ in range(100)]
    got = [r.predicted for r in toxicity.score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), index).orderBy("doc_id").collect()]
    assert sum(got[:100]) >= 95 and sum(got[100:150]) == 50 and sum(got[150:]) <= 5


def test_search_is_exact_over_postings_and_columns(monkeypatch):
    monkeypatch.setattr(toxicity, "COLUMNS", 40)
    rng = np.random.default_rng(14)
    vectors = []
    for i in range(300):
        t = np.unique(np.minimum(rng.geometric(0.01, 60), 900))
        vectors.append((i, i % 2, t, rng.integers(1, 5, len(t))))
    index = toxicity.Index(np.arange(901, dtype=np.uint64), rng.random(901) + 0.01, vectors)
    dense = np.zeros((300, 901))
    for i, (t, w) in enumerate(index.vectors):
        dense[i, t] = w
    found = index.search(index.vectors, skip=list(range(300)))
    assert (index.column >= 0).sum() == 40 and len(index.member)
    for i, (place, sims) in enumerate(found):
        all_ = dense @ dense[i]
        all_[i] = -1
        order = np.lexsort([np.arange(300), -np.round(all_, 12)])[: toxicity.NEAREST]
        assert place.tolist() == order.tolist() and np.allclose(sims, all_[order])


def test_pipeline_stages(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(12)
    docs, labels = toxic_corpus(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(1000, rows[1][1]), (1001, None), (1002, ""), (1003, "question alpha beta gamma delta"), (1004, " ".join(rows[2][1].split()[:30] + [f"n{rng.random()}" for _ in range(80)]))]
    full = [(d, t, "en", "s", len(t or "")) for d, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "Question alpha beta")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stage = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = {}
    for name, fn in corpus_pipeline.STAGES:
        stage = fn(spark, stage, str(tmp_path))
        left[name] = {r.doc_id: r for r in stage.collect()}
        stage = spark.createDataFrame(list(left[name].values()), stage.schema)
        if name != "byte_bpe":
            assert stage.columns == corpus_pipeline.COLUMNS
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    after = {d for d, _ in rows} - toxic
    assert set(left["toxicity"]) == after
    after -= {1000}
    assert set(left["near_duplicates"]) == after and set(left["substring_dedup"]) == after
    assert left["substring_dedup"][1004].text == " ".join(rows[-1][1].split()[30:])
    assert left["substring_dedup"][1004].n_chars == len(left["substring_dedup"][1004].text)
    assert set(left["decontamination"]) == after - {1003} == set(left["byte_bpe"])
    ran = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert ran == left["byte_bpe"]
    assert all(r.decoded_sha256 == hashlib.sha256((left["decontamination"][d].text or "").encode()).hexdigest() for d, r in ran.items())


def test_near_duplicates_of_edited_families(spark):
    """Families of copies, lightly and heavily edited, shortened, and edited again: components against all pairs."""
    rng = random.Random(21)
    vocabulary = [f"v{i}" for i in range(400)]
    texts = []
    for _ in range(4):
        base = rng.choices(vocabulary, k=120)
        line = list(base)
        for i in range(0, 60, 4):
            line[i] = f"sub{i}"  # a text of its own that has copies in turn
        for n in range(45):
            w = list(line if n % 3 == 2 else base)
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = rng.choice(["red", "green", *vocabulary[:20]])
            texts.append(" ".join(w[: rng.choice([120, 120, 100, 85])]))
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    sets = [shingles(t) for t in texts]
    component = list(range(len(sets)))

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((root(i), root(j)))
            component[b] = a
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: root(i) for i in range(len(sets))} and len(set(got.values())) < 0.8 * len(got)


def thue_morse(n, a, b):
    """A word of two letters whose sums of powers equal those of its complement, modulo 2**64 and for every odd base, from 1,024 letters on."""
    return "".join(a if bin(i).count("1") % 2 else b for i in range(n))


def test_words_that_cancel_out_in_sums_of_powers(spark):
    """Words and runs of bytes that a polynomial modulo 2**64 takes for equal, whatever its base."""
    one, other = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    rest = [f"w{i}" for i in range(19)]
    docs = frame(spark, [(1, " ".join([*rest, one]), 1, "x"), (2, " ".join([*rest, other]), 1, "x")])
    assert {r.n_removed for r in substring.dedup_substrings(docs).collect()} == {0}
    few = frame(spark, [(1, f"a b {one} c d", 1, "x"), (2, f"a b {other} c d", 1, "x"), (3, one, 1, "x"), (4, other, 1, "x"), (5, one.upper(), 1, "x")])
    groups = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(few).collect()}
    assert groups == {1: (1, 1), 2: (1, 2), 3: (1, 3), 4: (1, 4), 5: (1, 3)}
    rows = [(d, t, 1, "x") for d, t in [(1, "é" * 40 + one), (2, "ü" * 40 + other), (3, one), (4, other + "?"), (5, other), (6, one)]]
    plain_items, first = brute_bytes(rows, 50)
    want = sorted((d, removed) for d, removed in removed_bytes(plain_items, first, 50))
    for hot in (0, 4096):
        got = sorted((r.doc_id, r.n_removed) for r in suffixes.dedup_bytes(frame(spark, rows), hot=hot).collect())
        assert got == want, hot


def brute_bytes(rows, width):
    items, first = [(d, t.encode()) for d, t, *_ in rows], {}
    for d, b in items:
        for i in range(len(b) - width + 1):
            first[b[i : i + width]] = min(first.get(b[i : i + width], d), d)
    return items, first


def removed_bytes(items, first, width):
    for d, b in items:
        gone = set()
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < d:
                gone.update(range(i, i + width))
        yield d, len(gone)


def test_calls_are_handed_on_in_small_batches():
    """A batch of queries, each with thousands of leaves, isn't held at once; nor are the cells of a batch of entries."""
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((300, 8)).astype(np.float32)
    trees = forest.Forest(rng.standard_normal((4096, 8)), 8, 9)
    batch = pa.RecordBatch.from_pydict({"q": list(range(300)), "vector": vectors.tolist()})
    sizes, got = [], []
    for out in forest._calls(trees, iter([batch]), 640, 2, 3, "<f4"):
        sizes.append(out.num_rows)
        got += zip(out.column(0).to_pylist(), out.column(1).to_pylist(), out.column(2).to_pylist())
    assert max(sizes) < 2 * forest.ROWS and sum(sizes) == 300 * 640 * 2
    turns = forest._part(np.arange(300), 3)
    probed = [[(leaf * 2 + s) * 3 + turns[q] for leaf in trees.probe(vectors[q].astype(float), 640) for s in range(2)] for q in (0, 150, 299)]
    assert [sorted(c for c, q, _ in got if q == x) for x in (0, 150, 299)] == [sorted(p) for p in probed]
    assert all(v == vectors[q].tobytes() for _, q, v in got[:: 9973])
    entries = pa.RecordBatch.from_pydict({"vector": vectors.tolist(), "ids": [[i] for i in range(300)]})
    cells = list(forest._dealt(trees, iter([entries]), 8, 2, 64, "<f4"))
    assert max(c.num_rows for c in cells) <= forest.ROWS and sum(c.num_rows for c in cells) == 300 * 8 * 64
