"""Token counts with overlap resynchronisation.

Huge texts, those above CHUNK characters, go as overlapping chunks whose tokens keep character offsets. Neighbouring
chunks are spliced at a common boundary inside the overlap that is proven stable: behind tokens that both chunks hold at
the same place, letters only or marks only. Two facts make that a proof. An encoding by ranked merges is the one sequence
whose every two neighbouring tokens are the encoding of their joined text; in the spliced sequence every such pair stands
in one of the chunks. And a run of letters or of marks ends where its class ends, however it began, so both chunks cut
what follows into the same words (an apostrophe may begin a contraction, so it proves nothing; chunks begin at characters
that don't compose with what stands before them). That holds inside a word of any length too, so scripts without white
space and long codes cost no more than others: time is linear, memory a chunk's. If an overlap has no such boundary it is
doubled, in the end to both chunks joined, so the count is always the whole text's.

By the same proof a text of up to CHUNK characters has the tokens of its pieces between white space; the counts of pieces
seen before are kept, so the library encodes each of them once. Both need a vocabulary that cuts as WORDS does and drops
white space; with any other (`fits` looks) the library encodes whole texts.

Defined results: null is empty and has no tokens; special strings inside a text are handled as the library's default;
repeated rows each give a row; a null id stays null; columns of docs other than the id and the text may have any names.
"""

from __future__ import annotations

import bisect
import functools
import json
import os
import re
import unicodedata
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, OVERLAP = 1 << 14, 1 << 7
BATCH_CHARS = 1 << 20
KEPT = 1 << 19  # pieces
STABLE = " \n\r\t"
# Fixed value: the pattern of the vocabularies whose chunks can be spliced.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core already
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def fits(path: str) -> bool:
    """Whether a vocabulary drops white space and cuts words as WORDS does."""
    made = json.loads(tokenizer(path).to_str())
    cut = made["pre_tokenizer"] or {}
    first = (cut.get("pretokenizers") or [cut])[0]
    plain = all(not t["normalized"] and not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in made["added_tokens"])
    return plain and first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert")) and first["pattern"].get("Regex") == WORDS and made["model"]["type"] == "BPE" and not made["model"]["dropout"]


class Chunk(NamedTuple):
    """An encoded part of a text: offsets within the part, ids, and where the part begins."""

    offsets: list[tuple[int, int]]
    ids: list[int]
    begin: int


def _encode(tk, text: str, start: int, end: int) -> Chunk:
    e = tk.encode(text[start:end], add_special_tokens=False)
    return Chunk(e.offsets, e.ids, start)


def _apart(c: str) -> bool:
    """Whether a character doesn't compose with what stands before it."""
    return unicodedata.category(c)[0] in "LNZSPC" and not "\u1160" <= c <= "\u11ff" and not "\ud7b0" <= c <= "\ud7ff"


def _cut(text: str, at: int, least: int) -> int:
    """The last place up to `at` where a chunk may begin or end; `least` if there is none."""
    while at > least and at < len(text) and not _apart(text[at]):
        at -= 1
    return at


def _groups(chunk: Chunk, first: int, start: int, end: int) -> dict[tuple[int, int], tuple[int, list]]:
    """Tokens from number `first` on that lie within start and end, by the characters they share: (begin, end) of each group,
    the number of tokens up to its end, and its ids."""
    offsets, base = chunk.offsets, chunk.begin
    out, i = {}, max(first, bisect.bisect_left(offsets, start - base, key=lambda o: o[0]))
    while i < len(offsets) and offsets[i][0] + base < end:
        (a, b), j = offsets[i], i + 1
        while j < len(offsets) and offsets[j][0] < b:
            b, j = max(b, offsets[j][1]), j + 1
        if b + base <= end:
            out[a + base, b + base] = j, chunk.ids[i:j]
        i = j
    return out


def _plain(part: str) -> bool:
    """Letters only, or marks only and no apostrophe."""
    letters = [unicodedata.category(c)[0] for c in part]
    return all(x == "L" for x in letters) or ("'" not in part and all(x in "PS" for x in letters))


def _splice(text: str, left: Chunk, skipped: int, right: Chunk, start: int, end: int) -> tuple[int, int] | None:
    """How many tokens of left stay and of right go, for a common token near the middle of the overlap text[start:end]. The
    first `skipped` tokens of left are gone already."""
    a, b = _groups(left, skipped, start + 1, end - 1), _groups(right, 0, start + 1, end - 1)
    middle = (start + end) // 2
    for place in sorted(a.keys() & b.keys(), key=lambda p: abs(p[1] - middle)):
        if a[place][1] == b[place][1] and _plain(text[place[0] : place[1]]):
            return a[place][0], b[place][0]
    return None


def count_long(tk, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text, a chunk at a time; memory is a chunk's, but for texts without any stable boundary."""
    overlap = max(overlap, _longest(tk) + 3)  # no special string holds the whole overlap
    total, begin, end = 0, 0, _cut(text, min(chunk, len(text)), 0) or min(chunk, len(text))
    left, skipped = _encode(tk, text, begin, end), 0
    while end < len(text):
        width, wanted = overlap, min(len(text), end + chunk)
        following = _cut(text, wanted, end)
        following = following if following > end else wanted
        while True:
            start = _cut(text, max(begin, end - width), begin)
            right = _encode(tk, text, start, following)
            found = _splice(text, left, skipped, right, start, end) if start > begin else None
            if found is not None:
                total += found[0] - skipped
                begin, skipped = start, found[1]
                break
            if start == begin:  # the overlap is all of the left chunk: both are one chunk now
                skipped = _same_skip(left, right, skipped)
                break
            width *= 2
        left, end = right, following
    return total + len(left.ids) - skipped


def _longest(tk) -> int:
    return max((len(t.content) for t in tk.get_added_tokens_decoder().values()), default=0)


def _same_skip(left: Chunk, right: Chunk, skipped: int) -> int:
    """Tokens of a joined chunk that are counted already: they begin as the left chunk's do, up to the splice."""
    if left.ids[:skipped] != right.ids[:skipped] or left.offsets[:skipped] != right.offsets[:skipped]:
        raise ValueError("a splice wasn't stable")
    return skipped


class Pieces:
    """Token counts of pieces without stable boundaries, kept between texts."""

    def __init__(self, tk):
        self.tk, self.known = tk, {}

    def count(self, texts: list[list[str]]) -> list[int]:
        known = self.known
        new = [p for p in set().union(*texts) if p not in known]
        if len(known) + len(new) > KEPT:
            known.clear()
            new = list(set().union(*texts))
        known.update(zip(new, map(len, self.tk.encode_batch_fast(new, add_special_tokens=False))))
        return [sum(map(known.__getitem__, t)) for t in texts]


SPLIT = re.compile(f"[^{STABLE}]+")


def count_batch(pieces: Pieces, texts: list[str], chunk: int = CHUNK) -> list[int]:
    out, short, size = [0] * len(texts), {}, 0

    def flush():
        for i, n in zip(short, pieces.count(list(short.values()))):
            out[i] = n
        short.clear()

    for i, text in enumerate(texts):
        if len(text) > chunk:
            out[i] = count_long(pieces.tk, text, chunk)
        else:
            short[i] = SPLIT.findall(text)
            size += len(text)
            if size > BATCH_CHARS:
                flush()
                size = 0
    flush()
    return out


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of docs."""

    def run(batches):
        tk, known = tokenizer(path), fits(path)
        pieces = Pieces(tk)
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            counts = count_batch(pieces, texts) if known else [len(tk.encode(t, add_special_tokens=False).ids) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.col(f"`{text_col}`").cast("string")
    chosen = docs.select(F.col(f"`{id_col}`").cast("long"), text, F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    return chosen.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
