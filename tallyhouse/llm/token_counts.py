"""Token counts by overlap resynchronisation.

A text is encoded in chunks of ``chunk`` characters that overlap.  One that fits a
single chunk has no border; it is counted by the words between its white space
(the boundaries proven below), each distinct word going to the library once for as
long as the worker's bounded table of words holds it.  Neighbouring
chunks are spliced at a boundary that both encodings show and that is proven
stable: a token of either chunk starts there, right behind an ASCII white-space
character, and the tokens of both chunks from there to the last white space of the
overlap agree in place and id.  The library's word vocabulary drops white space
before it merges, so no token, merge or normalisation reaches across such a place
and what stands left of it cannot change what stands right of it.  If an overlap
holds no such place it is doubled, leftwards, until one is found; where the left
chunk holds none at all it is encoded again, twice as long, so a text without
white space is in the end encoded whole.  A chunk's offsets are looked up only in
its overlaps; tokens are counted by their indices and never listed.

Null texts are empty texts and have no tokens.  Repeated rows give repeated
results, empty tables empty results, extra columns are ignored whatever their names.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm.common import RecentlyUsed, map_batches, read_input, tokenizer_path

CHUNK_CHARS = 8_192
OVERLAP_CHARS = 128
WORDS_KEPT = 400_000  # counts a worker keeps, twice at most, of words of up to WORD_CHARS characters
WORD_CHARS = 64
TOKEN_LIMIT = 2048
BEHIND_WHITE = re.compile(r"(?<=[ \n\t\r])\S")  # white space for which the boundary is proven
WHITE_END = re.compile(r".*[ \n\t\r]", re.DOTALL)

_LOADED: dict = {}


def tokenizer(name: str):
    """One single-threaded library tokenizer a Python worker: no padding, no truncation."""
    if name not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer_path(name))
        t.no_padding()
        t.no_truncation()
        _LOADED[name] = t
    return _LOADED[name]


class Chunk:
    """The encoding of ``text[begin:end]``, asked for tokens by their places in the text."""

    def __init__(self, tok, text: str, begin: int, end: int):
        self.begin, self.end = begin, end
        self.found = tok.encode(text[begin:end], add_special_tokens=False)
        self.ids = self.found.ids

    def place(self, token: int) -> int:
        return self.begin + self.found.token_to_chars(token)[0]

    def starting_at(self, place: int) -> int | None:
        """The first token that starts at ``place``."""
        token = self.found.char_to_token(place - self.begin)
        return token if token is not None and self.place(token) == place else None

    def below(self, place: int) -> int:
        """How many tokens start in front of ``place``, which lies near the end of the tokens asked for."""
        low, high = 0, len(self.ids)
        while low < high:
            middle = (low + high) // 2
            if self.place(middle) < place:
                low = middle + 1
            else:
                high = middle
        return low

    def tokens(self, first: int, end: int) -> list[tuple[int, int]]:
        return [(self.place(t), self.ids[t]) for t in range(first, end)]


def _boundary(text: str, left: Chunk, right: Chunk) -> tuple[int, int, int] | None:
    """The first stable boundary: its place, and the token of either chunk that starts there.

    The left chunk's last word may be cut, so agreement is asked for up to the
    last white space in front of the chunk's end.
    """
    white = WHITE_END.match(text, right.begin, left.end)
    if white is None:
        return None
    last = white.end() - 1
    a, b = left.below(last), right.below(last)
    for m in BEHIND_WHITE.finditer(text, right.begin, last):
        i, j = left.starting_at(m.start()), right.starting_at(m.start())
        if i is not None and j is not None and left.tokens(i, a) == right.tokens(j, b):
            return m.start(), i, j
    return None


def stretches(tok, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> Iterator[tuple[Chunk, int, int]]:
    """Chunk by chunk, the range of its tokens that belongs to the text; together all tokens, in order."""
    n, low, first, wide = len(text), 0, 0, overlap
    left = Chunk(tok, text, 0, min(n, chunk))
    while left.end < n:
        begin = left.end - wide
        if begin > low:
            right = Chunk(tok, text, begin, min(n, begin + max(chunk, 2 * wide)))
            at = _boundary(text, left, right)
            if at is None:  # alignment failed: twice the overlap
                wide *= 2
                continue
            yield left, first, at[1]
            left, (low, _, first), wide = right, at, overlap
        else:  # no boundary in the whole left chunk: twice the chunk
            left, first, wide = Chunk(tok, text, low, min(n, 2 * left.end - low)), 0, overlap
    yield left, first, len(left.ids)


def encode_spliced(
    tok, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> list[tuple[int, int]]:
    """(place, id) of every token of a text, chunk by chunk."""
    return [x for c, first, end in stretches(tok, text, chunk, overlap) for x in c.tokens(first, end)]


def count_spliced(tok, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> tuple[int, int]:
    """How many tokens a text has, and from how many spliced chunks they come."""
    parts = [end - first for _, first, end in stretches(tok, text, chunk, overlap)]
    return sum(parts), len(parts)


class WordCounts(RecentlyUsed):
    """Tokens of a word without white space, as the library gives them; long words are not kept."""

    def __init__(self, tok):
        super().__init__(lambda word: len(tok.encode_batch_fast([word], add_special_tokens=False)[0]), WORDS_KEPT)

    def __missing__(self, word):
        return super().__missing__(word) if len(word) <= WORD_CHARS else self.make(word)

    def of(self, text: str) -> int:
        blanks = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return sum(map(self.__getitem__, blanks.split(" ")))


def count_tokens(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "word_bpe_49k.json",
    limit: int = TOKEN_LIMIT,
    huge_chars: int | None = None,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit, n_chunks.  One narrow pass, no shuffle.

    Texts of more than ``huge_chars`` characters (by default ``chunk``) are cut into chunks.
    """
    whole = chunk if huge_chars is None else huge_chars

    def run(batches):
        tok = tokenizer(vocabulary)
        words = WordCounts(tok)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            counts = []
            for value in texts:
                t = value.as_py()
                counts.append((words.of(t), 1) if len(t) <= whole else count_spliced(tok, t, chunk, overlap))
            n, chunks = pa.array([c[0] for c in counts], pa.int64()), pa.array([c[1] for c in counts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.cast(pc.binary_length(texts), pa.int64()), n, pc.greater(n, limit), chunks],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks"],
            )

    src = df.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"cast(`{text_col}` as string) AS text")
    return map_batches(src, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks long")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_input(spark, sf_dir, "documents"))
