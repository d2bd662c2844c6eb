"""SentencePiece encoding and decoding with a merge-type prefix table.

A byte-pair vocabulary encodes every prefix of a text to a sequence whose last
token is unique.  The table ``last[i]`` holds that token for each prefix of
length ``i``.  An Aho-Corasick automaton over the vocabulary lists the tokens
that end at ``i``; such a token ``t`` is the one to store exactly if the pair
``(last[i - len(t)], t)`` is compatible, that is, if the merges applied to the
joined strings of the pair end in that very pair.  The ids are then recovered
backwards from the end of the table.  Pair tests are remembered per worker.

Normalisation (white-space marks, prefix) and ``decode`` are the library's.
The normalised text is cut where the vocabulary can have no token across (left
of a white-space mark that follows another character, and between characters
that no piece holds next to each other), so each distinct stretch is encoded
once per worker and cached.  The cut never changes the result.

Null texts are empty texts; an empty text has no ids and decodes to ''.
Repeated rows give repeated results, empty tables empty results, extra columns
are carried along (`encode_documents`) whatever their names.  A character
outside the vocabulary becomes its UTF-8 byte pieces.  Models with user-defined
symbols, unused pieces, or without byte pieces are refused with ValueError.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain
from operator import itemgetter

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tallyhouse.llm.common import RecentlyUsed, fresh_name, map_batches, read_input, tokenizer_path

MARK = "▁"  # fixed value: the library's white-space mark
CACHE_WORDS = 500_000  # with all caches about 0.6 GB a worker, for as long as the worker lives
SMALL_CACHE_WORDS = 60_000  # for workers that do other work before and after
CACHE_PAIRS = 500_000
GROUP_TEXTS = 256
_IDS, _DECIMAL = itemgetter(0), itemgetter(1)


class PrefixTableEncoder:
    """Encodes normalised text with the vocabulary of one SentencePiece BPE model."""

    def __init__(self, model_file: str, cache_words: int = CACHE_WORDS):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        sp, n = self.sp, self.sp.get_piece_size()
        self.rank: dict[str, float] = {}  # lower merges first
        self.ids: dict[str, int] = {}
        bytes_: dict[int, int] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                bytes_[int(piece[3:5], 16)] = i
            elif sp.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.ids[piece] = i
                self.rank[piece] = -sp.get_score(i)
        if len(bytes_) != 256:
            raise ValueError("only models with all 256 byte pieces are supported")
        self.byte_ids = [bytes_[b] for b in range(256)]
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.alone: dict[str, bool] = {}
        self.words = RecentlyUsed(self._word, cache_words)
        self.parts = RecentlyUsed(self._part, cache_words * 4 // 5)
        self.neighbours = {two for p in self.ids for two in zip(p, p[1:])}
        self._cut = self._cut_pattern()

    def _cut_pattern(self) -> re.Pattern | None:
        """Words of normalised text: cut left of each white-space mark that follows another
        character, and around ASCII characters that no piece holds.

        None if some piece holds a mark behind another character.
        """
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            return None
        held = set().union(*self.ids)
        lone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in held)
        return re.compile(f"{MARK}*[^{MARK}{lone}]+|{MARK}+" + (f"|[{lone}]" if lone else ""))

    def _parts(self, word: str) -> list[str]:
        """``word`` without the signs at its end that no piece holds behind their left neighbour, and those signs."""
        inside, n = self.neighbours, len(word)
        while n > 1 and (word[n - 2], word[n - 1]) not in inside:
            n -= 1
        return [word] if n == len(word) else [word[:n], *word[n:]]

    def merged(self, text: str) -> list[str]:
        """The pieces that repeated merging of the best adjacent pair gives, for short texts."""
        symbols, rank = list(text), self.rank
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                r = rank.get(symbols[i] + symbols[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(left + right) == [left, right]
        return known

    def reachable(self, piece: str) -> bool:
        known = self.alone.get(piece)
        if known is None:
            known = self.alone[piece] = len(self.merged(piece)) == 1
        return known

    def tokens(self, text: str) -> list[str]:
        """The pieces of one normalised stretch (characters outside the vocabulary as themselves)."""
        n = len(text)
        last: list[str | None] = [None] * (n + 1)
        pairs, reachable, compatible = self.pairs, self.reachable, self.compatible
        for end, piece in self.automaton.iter(text):
            end += 1
            if last[end] is None:
                start = end - len(piece)
                if start:
                    before = last[start] or text[start - 1]
                    fits = pairs.get((before, piece))
                    if fits is None:
                        fits = compatible(before, piece)
                else:
                    fits = reachable(piece)
                if fits:
                    last[end] = piece
        out, i = [], n
        while i:
            t = last[i] or text[i - 1]
            out.append(t)
            i -= len(t)
        out.reverse()
        return out

    def _part(self, text: str) -> tuple[int, ...]:
        ids: list[int] = []
        for t in self.tokens(text):
            i = self.ids.get(t)
            if i is None:
                ids.extend(self.byte_ids[b] for b in t.encode())
            else:
                ids.append(i)
        return tuple(ids)

    def _word(self, word: str) -> tuple[tuple[int, ...], bytes]:
        ids = tuple(chain.from_iterable([self.parts[p] for p in self._parts(word)]))
        return ids, ",".join(map(str, ids)).encode()

    def words_of(self, text: str) -> list[tuple[tuple[int, ...], bytes]]:
        """(ids, ids as decimal text) of each word of a raw text."""
        if not text:
            return []
        normal = self.sp.normalize(text)
        words = [normal] if self._cut is None else self._cut.findall(normal)
        return list(map(self.words.__getitem__, words))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(_IDS, self.words_of(text))))

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids) if ids else ""


_ENCODERS: dict[tuple[str, int], PrefixTableEncoder] = {}


def encoder(model_name: str, cache_words: int = CACHE_WORDS) -> PrefixTableEncoder:
    """One encoder a Python worker; its automaton and caches serve all tasks of that worker."""
    key = (model_name, cache_words)
    if key not in _ENCODERS:
        _ENCODERS[key] = PrefixTableEncoder(tokenizer_path(model_name), cache_words)
    return _ENCODERS[key]


def encode_documents(
    df: DataFrame,
    text_col: str = "text",
    model_name: str = "piece_bpe_32k.model",
    digest: bool = False,
    cache_words: int = SMALL_CACHE_WORDS,
) -> DataFrame:
    """``df`` with ``n_tokens`` (long), ``token_ids`` (array of int) and ``decoded_text`` (string) added.

    With ``digest`` the decoded text's SHA-256, ``decoded_sha256``, in its place.
    Existing columns keep their names; an added column whose name is taken
    gets leading underscores.
    """
    added = [fresh_name(df, c) for c in ("n_tokens", "token_ids", "decoded_sha256" if digest else "decoded_text")]
    at = df.columns.index(text_col)

    def run(batches):
        enc = encoder(model_name, cache_words)
        for batch in batches:
            for k in range(0, batch.num_rows, GROUP_TEXTS):
                some = batch.slice(k, GROUP_TEXTS)
                ids, decoded = [], []
                for t in some.column(at).to_pylist():
                    ids.append(enc.encode(t or ""))
                    text = enc.decode(ids[-1])
                    decoded.append(hashlib.sha256(text.encode()).hexdigest() if digest else text)
                n = pa.array([len(x) for x in ids], pa.int64())
                columns = [*some.columns, n, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    schema = StructType(
        [StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema)]
        + [
            StructField(f"c{len(df.columns) + i}", t)
            for i, t in enumerate((LongType(), ArrayType(IntegerType()), StringType()))
        ]
    )
    names = [f"c{i}" for i in range(len(df.columns))]
    return map_batches(df.toDF(*names), run, schema).toDF(*df.columns, *added)


def digest_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_name: str = "piece_bpe_32k.model"
) -> DataFrame:
    """Per document: id, number of ids, SHA-256 of the ids as decimal text, SHA-256 of the decoded text.

    Same encoder as :func:`encode_documents`; only digests leave the task, so
    the ids of 100 TB of text never have to be written to be compared.
    """

    def run(batches):
        enc = encoder(model_name)
        for batch in batches:
            counts, ids_hash, text_hash = [], [], []
            for t in batch.column(1).to_pylist():
                words = enc.words_of(t or "")
                ids = list(chain.from_iterable(map(_IDS, words)))
                counts.append(len(ids))
                ids_hash.append(hashlib.sha256(b",".join(map(_DECIMAL, words))).hexdigest())
                text_hash.append(hashlib.sha256(enc.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(text_hash)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    src = df.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"cast(`{text_col}` as string) AS text")
    return map_batches(src, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(read_input(spark, sf_dir, "documents"))
