"""Encoding and decoding with a SentencePiece model, by a Viterbi pass that shared prefixes run once.

White space is marked as in SentencePiece: a mark stands before the text and for every space, and the text is cut before
each run of marks. The distinct marked words of a batch are sorted, which is a depth-first walk of their trie: the
forward states of the characters a word shares with the one before it are kept, only the rest is computed.

The forward step depends on the model type stated in the file. `unigram`: the best score of any segmentation that ends
here, scores of pieces added. `bpe`: scores of such models are merge ranks, whose sums mean nothing; there a
segmentation is right if every piece, and every two neighbouring pieces, are what the merges themselves make of that
stretch. Exactly one segmentation of each prefix is, so the state is its last piece, and the step tries the pieces that
end here for the one that fits the state it starts from. Both give the ids that the SentencePiece library gives.
Characters without a piece become their bytes where the model has byte pieces, else the unknown piece.

Defined results: null and empty texts have no ids and decode to the empty text; U+2581 in a text is read as a space, as
SentencePiece does, and decodes to one (`round_trip` is false there); other texts decode to themselves; repeated rows
are each encoded; an empty table gives no rows; other columns are not read, or passed on by `with_pieces`.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from tallyward.llm.common import CACHE_ENTRIES, id_and_text, per_batch

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BYTE = re.compile(r"<0x([0-9A-F]{2})>")
#: Characters whose words are held at once.
TEXT_AT_ONCE = 500_000
UNIGRAM, BPE = 1, 2
LAST = float("inf")


class Pieces:
    """The pieces of a model file, with encoder and decoder."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        file = proto.ModelProto.FromString(model)
        if file.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models have a segmentation of this kind")
        if file.normalizer_spec.precompiled_charsmap or file.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("models that rewrite the text before encoding it are not read")
        kinds = proto.ModelProto.SentencePiece
        self.merges = file.trainer_spec.model_type == BPE
        self.prefix = MARK if file.normalizer_spec.add_dummy_prefix else ""
        self.names = [p.piece for p in file.pieces]
        self.ids = {p.piece: i for i, p in enumerate(file.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
        self.scores = [p.score for p in file.pieces]
        self.unknown = next(i for i, p in enumerate(file.pieces) if p.type == kinds.UNKNOWN)
        self.bytes = {int(BYTE.fullmatch(p.piece)[1], 16): i for i, p in enumerate(file.pieces) if p.type == kinds.BYTE}
        self.reach: dict[str, int] = {}  # the longest piece that ends with these three characters
        for p in self.ids:
            if len(p) > 2:
                self.reach[p[-3:]] = max(len(p), self.reach.get(p[-3:], 0))
        self.low = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        self.words = self._words()
        self.ranks = {p: -self.scores[i] for p, i in self.ids.items()} if self.merges else {}
        self.edges: dict[str, tuple | None] = {}
        for p in self.ranks:
            self._edges(p)
        self.known: dict[str, bytes] = {}  # of the running task
        self.known_before: dict[str, bytes] = {}
        self.text_of = [b"" if p.type == kinds.CONTROL else p.piece.encode() for p in file.pieces]
        self.text_of[self.unknown] = " \u2047 ".encode()
        for b, i in self.bytes.items():
            self.text_of[i] = bytes([b])

    def _words(self) -> re.Pattern:
        """Cuts a marked text where no piece can cross: before marks, around characters that only stand alone, and, if
        no piece mixes them, between letters and other signs."""
        long = [p for p in self.ids if len(p) > 1]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in long):
            return re.compile("(?s).+")
        joined = sorted(set("".join(long)) - {MARK})
        kinds = [[c for c in joined if c.isalpha()], [c for c in joined if not c.isalpha()]]
        if any(len({c.isalpha() for c in p.lstrip(MARK)}) > 1 for p in long):
            kinds = [joined]
        runs = [f"{MARK}*[{re.escape(''.join(k))}]+" for k in kinds if k]
        return re.compile("|".join([*runs, f"{MARK}+", "(?s:.)"]))

    # -- segmentation ------------------------------------------------------

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge is the last one on the way to this piece; None if merges do not lead to it."""
        parts = list(piece)
        while len(parts) > 2:
            best = min(((self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.ranks), default=None)
            if best is None:
                return None
            at = best[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _edges(self, piece: str) -> tuple | None:
        """What grows to this piece at its right and at its left edge: (stretch, rank of the merge that ends it)."""
        if piece in self.edges:
            return self.edges[piece]
        found = (((piece, LAST),), ((piece, LAST),)) if len(piece) == 1 else None
        if piece in self.ranks and (halves := self._halves(piece)):
            rank, sides = self.ranks[piece], (self._edges(halves[1]), self._edges(halves[0]))
            found = tuple((*sides[k][k][:-1], (sides[k][k][-1][0], rank), (piece, LAST)) for k in (0, 1)) if all(sides) else None
        self.edges[piece] = found
        return found

    def _fit(self, xs: tuple, ys: tuple) -> bool:
        """Whether the merges keep a border: no merge across it comes before those that grow its two sides."""
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = xs[i], ys[j]
            across = self.ranks.get(x + y, LAST)
            if across < x_ends and across <= y_ends:
                return False
            if x_ends <= y_ends:
                if x_ends == LAST:
                    return True
                i += 1
            else:
                j += 1

    def _forward_merges(self, word: str, states: list) -> None:
        """Appends the states of the characters of a word that have none yet: the last piece's right edge, and it."""
        edges_of, fit, reach_of = self.edges.get, self._fit, self.reach.get
        for end in range(len(states), len(word) + 1):
            start = max(0, end - reach_of(word[end - 3 : end], 2)) if end > 2 else 0
            while start < end:
                edges = edges_of(piece := word[start:end])
                if edges is not None and (not start or fit(states[start][0], edges[1])):
                    states.append((edges[0], piece))
                    break
                start += 1
            else:  # a character that is no piece
                states.append((self._edges(word[end - 1])[0], word[end - 1]))

    def _forward_scores(self, word: str, states: list) -> None:
        """The same for scores: the best sum of any segmentation up to here, and its last piece."""
        for end in range(len(states), len(word) + 1):
            reach = self.reach.get(word[end - 3 : end], 2) if end > 2 else end
            best = None
            for start in range(max(0, end - reach), end):
                piece = word[start:end]
                at = self.ids.get(piece)
                if at is None and end - start > 1:
                    continue
                score = states[start][0] + (self.low if at is None else self.scores[at])
                if best is None or score > best[0]:
                    best = score, piece
            states.append(best)

    def segment_all(self, words: list[str]) -> dict[str, list[str]]:
        """The pieces of each word; the words are walked in order, as a trie."""
        forward = self._forward_merges if self.merges else self._forward_scores
        found, states, before = {}, [(0.0, "")], ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del states[shared + 1 :]
            forward(word, states)
            pieces, end = [], len(word)
            while end:
                piece = states[end][1]
                pieces.append(piece)
                end -= len(piece)
            found[word] = pieces[::-1]
            before = word
        return found

    def _ids(self, pieces: list[str]) -> bytes:
        out: list[int] = []
        for piece in pieces:
            at = self.ids.get(piece)
            if at is not None:
                out.append(at)
            elif self.bytes:
                out += [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return array("i", out).tobytes()

    # -- texts -------------------------------------------------------------

    def marked(self, text: str) -> list[str]:
        """The marked words of a text."""
        if not text:
            return []
        return self.words.findall(self.prefix + text.replace(" ", MARK))

    def forget(self) -> None:
        """Drop the known words."""
        self.known, self.known_before = {}, {}

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; words are split and walked for some texts at a time."""
        out, at = [], 0
        while at < len(texts):
            split, size = [], 0
            while at < len(texts) and size < TEXT_AT_ONCE:
                split.append(self.marked(texts[at]))
                size += len(texts[at])
                at += 1
            if len(self.known) >= CACHE_ENTRIES // 2:  # with those before them, as many as a worker may keep
                self.known, self.known_before = {}, self.known
            new = set(chain.from_iterable(split)).difference(self.known)
            again = {w: self.known_before[w] for w in new if w in self.known_before}
            self.known.update(again)
            new.difference_update(again)
            self.known.update((word, self._ids(pieces)) for word, pieces in self.segment_all(list(new)).items())
            out += (np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32) for words in split)
        if self.bytes:
            return out
        unknown = [ids == self.unknown for ids in out]  # neighbouring unknown characters are one piece
        return [ids[~(u & np.concatenate([[False], u[:-1]]))] if len(ids) else ids for ids, u in zip(out, unknown, strict=True)]

    def decode(self, ids) -> str:
        """The text of ids: byte pieces joined, marks as spaces, the first one dropped."""
        text = b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def pieces(model: bytes) -> Pieces:
    """One per worker and model, so that it is read once, and known words outlive a batch."""
    return Pieces(model)


def _by_task(shared, make):
    """As `per_batch`; when a task ends, the worker, which also serves what comes after, keeps the model but no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = False
        for out in per_batch(make)(batches):
            used = True
            yield out
        if used:
            pieces(shared.value).forget()

    return run


def _ids_column(encoded: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, encoded)])
    flat = np.concatenate(encoded) if encoded else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def _model(df: DataFrame, path: str):
    with open(path, "rb") as file:  # a vocabulary of a fixed size, read once by the driver
        return df.sparkSession.sparkContext.broadcast(file.read())


def encoded(docs: DataFrame, model: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of each text, their number, the text they decode to, and whether that is the text."""
    shared = _model(docs, model)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, texts = pieces(shared.value), batch.column(1).to_pylist()
        ids = own.encode_batch(texts)
        back = [own.decode(i.tolist()) for i in ids]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), _ids_column(ids), pa.array(map(len, ids), pa.int64()), pa.array(back, pa.string()), pa.array([a == b for a, b in zip(back, texts, strict=True)])],
            ["doc_id", "ids", "n_ids", "decoded", "round_trip"],
        )

    return id_and_text(docs, doc_id, text).mapInArrow(_by_task(shared, make), "doc_id long, ids array<int>, n_ids long, decoded string, round_trip boolean")


def with_pieces(docs: DataFrame, model: str = MODEL, text: str = "text", ids_name: str = "ids", count_name: str = "n_ids", mark_name: str | None = None) -> DataFrame:
    """The rows with all their columns and the ids; a clashing column gives way to the new one.

    With `mark_name`, the ids are decoded, and the mark says whether that is the text.
    """
    shared = _model(docs, model)
    at = docs.columns.index(text)
    kept = [i for i, c in enumerate(docs.columns) if c not in (ids_name, count_name, mark_name)]
    schema = StructType([*(docs.schema[i] for i in kept), StructField(ids_name, ArrayType(IntegerType())), StructField(count_name, LongType())])
    if mark_name is not None:
        schema = schema.add(mark_name, BooleanType())

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, texts = pieces(shared.value), [t or "" for t in batch.column(at).to_pylist()]
        ids = own.encode_batch(texts)
        marks = [pa.array([own.decode(i.tolist()) == t for i, t in zip(ids, texts, strict=True)], pa.bool_())] if mark_name is not None else []
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), _ids_column(ids), pa.array(map(len, ids), pa.int64()), *marks], schema.names)

    return docs.mapInArrow(_by_task(shared, make), schema)


def decoded(rows: DataFrame, model: str = MODEL, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts of ids."""
    shared = _model(rows, model)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = pieces(shared.value)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.decode(i or []) for i in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return rows.select(f"`{doc_id}`", f"`{ids}`").mapInArrow(per_batch(make), "doc_id long, text string")
