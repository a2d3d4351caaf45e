"""Fingerprints against a plain version, and what they tell of edits."""

import hashlib
import random
import re

from tidemark.llm import imatch

KINDS = "doc_id long, text string, block long, role string, term string"  # the last three clash with names used inside


def words(text):
    return list(dict.fromkeys(w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w))


def plain(rows):
    """By row: edited text, fingerprints (sets of signatures) and likenesses, from whole tables in memory."""
    texts = [(d, t or "") for d, t, *_ in rows]
    df = {}
    for _, t in texts:
        for w in words(t):
            df[w] = df.get(w, 0) + 1
    band = {w for w, k in df.items() if int(len(texts) ** imatch.LOW) <= k <= int(len(texts) ** imatch.HIGH)}

    def signed(text):
        own = words(text)
        first, out = min(len(own).bit_length() - 1, imatch.DEEPEST) if own else 0, []
        for level in range(first, first + imatch.LEVELS):
            for i in range(imatch.SUBSETS):
                kept = sorted(w for w in own if w in band and int(hashlib.md5(w.encode()).hexdigest()[4 * i : 4 * i + 4], 16) < 1 << (16 - level))
                if kept:
                    out.append(f"{level}.{i}.{hashlib.md5(' '.join(kept).encode()).hexdigest()[:8]}")
        if own and not out:
            out = ["=" + hashlib.md5(" ".join(sorted(own)).encode()).hexdigest()]
        return first, out

    def like(a, b):
        if a[1] == b[1]:
            return 1.0
        low, high = max(a[0], b[0]), min(a[0], b[0]) + imatch.LEVELS - 1
        x, y = ({s for s in p[1] if s[0] != "=" and low <= int(s.split(".")[0]) <= high} for p in (a, b))
        places = {s.rsplit(".", 1)[0] for s in x | y}
        return len(x & y) / len(places) if places else 0.0

    ids = sorted({d for d, _ in texts if d is not None}, reverse=True)
    out = []
    for d, t in texts:
        other = None
        if d is not None:
            after = ids[(ids.index(d) + 1) % len(ids)]
            other = {x for e, x in texts if e == after}
            assert len(other) == 1  # in these tests an id has one text
            other = other.pop()
        edited = t[: len(t) - len(t) // 2] + (other or "")[: len(t) // 2]
        a, b = signed(t), signed(edited)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), " ".join(a[1]), " ".join(b[1]), round(like(a, b), 9), None if other is None else round(like(a, signed(other)), 9)))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(d, t, 1, "r", "t") for d, t in rows], KINDS).repartition(5)
    out = imatch.fingerprints(df)
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted(((*r[:5], round(r[5], 9), None if r[6] is None else round(r[6], 9)) for r in out.collect()), key=str)


def corpus(n=150):
    rng = random.Random(4)
    vocabulary = [f"w{i}{'é' if i % 3 else '字'}" for i in range(500)]
    rows = [(i * 7 - 200, " ".join(rng.choices(vocabulary, k=rng.randint(1, 120)) + ["the"])) for i in range(n)]
    rows += [(5000, rows[3][1]), (5001, rows[3][1]), (5002, None), (5003, ""), (5004, "  \n\t"), (5005, "THE the The"), (5006, "unheard of"), (5007, "long text of words " * 20_000), (5008, "𝄞clef" * 9)]
    return rows + [rows[7], rows[7], (None, rows[9][1]), (None, "two rows without an id"), (None, None)]


def test_fingerprints_equal_plain_version(spark, monkeypatch):
    rows = corpus()
    want = plain(rows)
    assert found(spark, rows) == want
    monkeypatch.setattr(imatch, "BROADCAST", 0)  # the lexicon is joined by shuffling
    assert found(spark, rows) == want
    same = {r[3] for r in want if r[0] in (5000, 5001, 3 * 7 - 200)}
    assert len(same) == 1 and next(r for r in want if r[0] == 5001)[6] == 1.0


def test_few_rows(spark):
    for rows in ([], [(4, "one document is next to itself here")], [(None, "no id")], [(1, "a b c"), (2, "d e f")], [(9, "copies of one row")] * 30):
        assert found(spark, rows) == plain(rows)


def test_an_id_with_several_texts(spark):
    got = found(spark, [(1, "first text here"), (1, "second text here"), (2, "another one with an end"), (2, "another one with an end")])
    assert len(got) == 4 and len({r for r in got if r[0] == 2}) == 1  # both rows of 2 see the same text of 1


def test_likeness_grows_with_what_is_shared(spark):
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(3000)]
    base = [rng.choices(vocabulary, k=200) for _ in range(60)]
    rows = [(2 * i, " ".join(w)) for i, w in enumerate(base)] + [(2 * i + 1, " ".join(w[:190] + rng.choices(vocabulary, k=10))) for i, w in enumerate(base)]
    got = found(spark, rows)
    near = [r[6] for r in got if r[0] % 2]  # the next of an odd document is what it was made from
    far = [r[6] for r in got if r[0] % 2 == 0]
    assert sum(near) / len(near) > 0.6 and sum(far) / len(far) < 0.05
    half = [r[5] for r in got]
    assert 0.1 < sum(half) / len(half) < 0.6


def test_main_path_is_native(spark):
    plan = imatch.fingerprints(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
