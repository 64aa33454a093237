"""SentencePiece BPE by exact backtracking.

Text is encoded without replaying merges over it.  From each position the longest
vocabulary match (Aho-Corasick) is tried first, then shorter ones; a token may follow
another only if merging the two texts again gives just these two tokens, and positions
from which nothing fits are marked in a bit field.  The result is the one that merging
by rank gives.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrain.llm.book import query, table
from landgrain.llm.words import parts

SPACE = "▁"
HELD = 1_000_000
"""Words kept with their ids in a worker; when there are more, all are dropped."""

_RUNS = re.compile(f"{SPACE}+|[^\\W\\d_]+|.", re.S)

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


@dataclass(frozen=True)
class Vocabulary:
    """Pieces in the order of their ids: text, score, and kind (`n`ormal, `b`yte, `c`ontrol, `u`nknown)."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str
    begin: int
    end: int
    own: tuple[bool, ...]
    """Whether merging the text of a normal piece gives the piece; others never occur in a result."""

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a model file whose text rules are: no normalisation, a space put in front, bytes for unknown characters."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        kinds = "".join("b" if sp.is_byte(i) else "c" if sp.is_control(i) else "u" if sp.is_unknown(i) else "n" for i in range(n))
        pieces, scores = tuple(sp.id_to_piece(i) for i in range(n)), tuple(sp.get_score(i) for i in range(n))
        score = {p: s for p, s, k in zip(pieces, scores, kinds) if k == "n"}
        own = tuple(k == "n" and merge(p, score) == [p] for p, k in zip(pieces, kinds))
        return Vocabulary(pieces, scores, kinds, sp.bos_id(), sp.eos_id(), own)


def merge(text: str, score: dict[str, float]) -> list[str]:
    """Merge the best adjacent pair, the leftmost of equals, until none is a piece."""
    out = list(text)
    while len(out) > 1:
        best, at = None, -1
        for k in range(len(out) - 1):
            s = score.get(out[k] + out[k + 1])
            if s is not None and (best is None or s > best):
                best, at = s, k
        if at < 0:
            break
        out[at : at + 2] = [out[at] + out[at + 1]]
    return out


class _Held(dict):
    """A dictionary that computes what it lacks and is emptied when it is full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= HELD:
            self.clear()
        self[key] = value = self.make(key)
        return value


class Codec:
    """Encode and decode with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self.normal = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == "n"}
        self.score = {p: v.scores[i] for p, i in self.normal.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == "b"}
        self.edges = [array("I", [i]).tobytes() for i in (v.begin, v.end)]
        self.surface = [bytes([int(p[3:5], 16)]) if k == "b" else p.replace(SPACE, " ").encode() if k == "n" else b"" if k == "c" else " ⁇ ".encode() for p, k in zip(v.pieces, v.kinds)]
        self.spaced = [k == "n" and p.startswith(SPACE) for p, k in zip(v.pieces, v.kinds)]
        self.matches = ahocorasick.Automaton()
        usable = {p for p, own in zip(v.pieces, v.own) if own}
        for p in usable:
            self.matches.add_word(p, len(p))
        # The next shorter piece that a piece starts with; after the shortest there is only its character.
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in usable or k == 1), None) for p in usable}
        self.matches.make_automaton()
        # Merges never join two characters that stand side by side in no piece.
        self.beside = {p[k : k + 2] for p in self.normal for k in range(len(p) - 1)}
        self.follows = _Held(lambda pair: merge(pair[0] + pair[1], self.score) == list(pair))
        self.parts = _Held(self._part_ids)
        self.words = _Held(self._word_ids)

    def longest(self, text: str, pos: int) -> str:
        """The longest piece that starts at a position; the character there if none does."""
        for last, size in self.matches.iter_long(text, pos):
            if last + 1 - size == pos:
                return text[pos : last + 1]
            break
        return text[pos]

    def backtrack(self, text: str) -> list[str]:
        """The tokens of a text, by longest matches with compatible neighbours."""
        n, follows, shorter, longest = len(text), self.follows, self.shorter, self.longest
        failed, out = bytearray(n + 1), []
        before, pos, token = None, 0, longest(text, 0)
        while True:
            while token is not None:
                end = pos + len(token)
                if not failed[end] and (before is None or follows[before, token]):
                    break
                token = shorter.get(token)
            if token is None:
                failed[pos] = 1
                token = out.pop()
                pos -= len(token)
                before = out[-1] if out else None
                token = shorter.get(token)
                continue
            out.append(token)
            if end == n:
                return out
            before, pos = token, end
            token = longest(text, pos)

    def _part_ids(self, text: str) -> bytes:
        ids: list[int] = []
        for token in self.backtrack(text):
            i = self.normal.get(token)
            if i is None:
                ids += [self.bytes[b] for b in token.encode("utf-8", "surrogatepass")]
            else:
                ids.append(i)
        return array("I", ids).tobytes()

    def _word_ids(self, word: str) -> bytes:
        """Ids of a word with a space before it; it is cut between runs of letters and others where no merge can cross."""
        if word.isalpha():
            return self._part_ids(SPACE + word)
        beside, runs = self.beside, _RUNS.findall(word)
        out, held = [], SPACE
        for run in runs:
            if held[-1] + run[0] in beside:
                held += run
            else:
                out.append(held)
                held = run
        out.append(held)
        head = out[0]
        first = self.words[head[1:]] if len(out) > 1 and head[1:].isalpha() else self._part_ids(head)
        return first + b"".join([self.parts[x] for x in out[1:]])

    def encode(self, text: str) -> bytes:
        """Ids of a text with begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return self.edges[0] + self.edges[1]
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            spaced = SPACE + text.replace(" ", SPACE)
            ids = [self.words[w[1:]] if w[1:2] not in ("", SPACE) else self.parts[w] for w in re.findall(f"{SPACE}+[^{SPACE}]*", spaced)]
        else:
            ids = map(self.words.__getitem__, text.split(" "))
        return self.edges[0] + b"".join(ids) + self.edges[1]

    def decode(self, ids: bytes) -> str:
        """Text of ids: pieces put together, without the space in front."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        body = b"".join(map(self.surface.__getitem__, numbers)).decode("utf-8", "each_byte")
        for i in numbers:
            if self.surface[i]:
                return body[1:] if self.spaced[i] else body
        return body


_CODECS: dict[str, Codec] = {}


def codec(vocabulary: Vocabulary) -> Codec:
    """The codec of a vocabulary, made once per worker."""
    name = hashlib.sha256(repr((vocabulary.pieces, vocabulary.scores, vocabulary.kinds)).encode()).hexdigest()
    if name not in _CODECS:
        _CODECS[name] = Codec(vocabulary)
    return _CODECS[name]


def tokenize(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: bool = True) -> DataFrame:
    """Add n_tokens, ids and decoded text (with `keep`), and the SHA-256 of both.

    Whole texts are encoded with begin and end ids; null reads as empty.  Other columns
    and repeated rows pass through; columns with the added names are replaced.  The
    vocabulary is shipped to the executors and has a fixed size.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep else [])]
    columns = [c for c in docs.columns if c not in added or c == text]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kinds = {"n_tokens": F.lit(0).cast("long"), "ids": F.array(F.lit(0)), "ids_sha256": F.lit(""), "decoded": F.lit(""), "decoded_sha256": F.lit("")}
    schema = docs.select(*columns).withColumns({c: kinds[c] for c in added}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            column = batch.column(columns.index(text))
            for a, b in parts(column):
                ids = [own.encode(t or "") for t in column.slice(a, b - a).to_pylist()]
                decoded = [own.decode(i) for i in ids]
                digest = lambda x: hashlib.sha256(x).hexdigest()
                made = [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([digest(i) for i in ids]), pa.array([digest(d.encode("utf-8", "surrogatepass")) for d in decoded])]
                if keep:
                    made += [pa.array([np.frombuffer(i, "<i4") for i in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, *made], [*columns, *added])

    return docs.select(*columns).mapInArrow(run, schema)


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op8_backtracking_pieces")
def op8(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return tokenize(docs, Vocabulary.load(public_model()), keep=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
