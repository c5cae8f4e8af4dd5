"""SentencePiece encoding of merge-type vocabularies by a score-ordered agenda.

A normalised text starts as single characters. The agenda holds every pair of
neighbours whose concatenation is a piece of the vocabulary, the best score
first and the leftmost among equals; the head is merged, the pairs it forms
with its new neighbours join the agenda, and pairs whose halves have changed
since are passed over. What is in no vocabulary becomes its UTF-8 bytes where
the model has byte pieces, else the unknown piece.

No piece spans from another character to the space mark, and some characters
stand in no piece of two or more; so the text falls apart before runs of
space marks and around such characters, and the agenda runs on each part by
itself (each distinct one once while it is remembered).

Models are files of the ``sentencepiece`` library of type BPE, without
user-defined and unused pieces. Its normaliser is used as it is; its encoder
checks, for each Arrow batch, the parts that are new in it.
"""

from __future__ import annotations

import functools
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from histoframe.llm.batches import steps

#: The mark that stands for a space inside pieces.
SPACE = "▁"

#: Distinct parts a worker remembers besides as many older ones, and the longest part it remembers.
_MEMO, _LONGEST = 500_000, 64

#: Types of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


class _Known(dict):
    """Ids of parts as int32 bytes, made on first use; ``fresh`` lists the parts they were made for."""

    def __init__(self, make) -> None:
        super().__init__()
        self._make, self._older, self.fresh = make, {}, []

    def __missing__(self, part: str) -> bytes:
        ids = self._older.get(part)
        if ids is None:
            ids = self._make(part)
            self.fresh.append(part)
        if len(part) <= _LONGEST:
            self[part] = ids
        return ids

    def age(self) -> None:
        """Forget what was not used since the parts were last too many."""
        if len(self) > _MEMO:
            self._older = dict(self)
            self.clear()


class PieceBpe:
    """Encoder and decoder for one model file's bytes."""

    def __init__(self, model: bytes) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec = proto.ModelProto.FromString(model)
        kinds = {p.type for p in spec.pieces}
        if spec.trainer_spec.model_type != proto.TrainerSpec.BPE or kinds - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("only BPE models of normal, byte, control and unknown pieces are supported")
        if spec.denormalizer_spec.precompiled_charsmap or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with a denormaliser or trailing space marks are not supported")
        normal = [(i, p.piece, p.score) for i, p in enumerate(spec.pieces) if p.type == _NORMAL]
        self._ids = {piece: i for i, piece, _ in normal}
        #: Place of a piece in the agenda: best score first, one place for equal scores.
        places = {score: place for place, score in enumerate(sorted({score for _, _, score in normal}, reverse=True))}
        self._places = {piece: places[score] for _, piece, score in normal}
        self._unknown = next(i for i, p in enumerate(spec.pieces) if p.type == _UNKNOWN)
        self._bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(spec.pieces) if p.type == _BYTE}
        if spec.trainer_spec.byte_fallback and len(self._bytes) != 256:
            raise ValueError("byte fallback needs all 256 byte pieces")
        self._fallback = spec.trainer_spec.byte_fallback
        self._strip = spec.normalizer_spec.add_dummy_prefix or spec.normalizer_spec.remove_extra_whitespaces
        self._strip_all = spec.normalizer_spec.remove_extra_whitespaces
        self._part = self._parts_pattern([piece for _, piece, _ in normal])
        self._known = _Known(self._encode_part)
        #: What each id adds to a decoded text, in UTF-8, and which ids keep a space they begin with.
        surface = spec.trainer_spec.unk_surface.encode("utf-8")
        self._surface = [p.piece.replace(SPACE, " ").encode("utf-8") for p in spec.pieces]
        self._stays = np.array([p.type in (_BYTE, _UNKNOWN) for p in spec.pieces])
        self._control = np.array([p.type == _CONTROL for p in spec.pieces])
        for i, p in enumerate(spec.pieces):
            if p.type != _NORMAL:
                self._surface[i] = bytes([int(p.piece[1:-1], 16)]) if p.type == _BYTE else surface if p.type == _UNKNOWN else b""

    @staticmethod
    def _parts_pattern(pieces: list[str]) -> re.Pattern[str]:
        """Parts of a text that no piece reaches across."""
        longer = [p for p in pieces if len(p) > 1]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in longer):
            return re.compile("(?s).+")
        bound = "".join(sorted({c for p in longer for c in p} - {SPACE}))
        inner = "[" + re.sub(r"([\\\]\[^-])", r"\\\1", bound) + "]" if bound else "(?!)"
        return re.compile(f"(?s){SPACE}+{inner}*|{inner}+|.")

    def _merged(self, text: str) -> list[str]:
        """Pieces of one part, by the agenda; a symbol is known by where it starts and ends."""
        place_of = self._places.get
        n = len(text)
        stop = list(range(1, n + 1))
        start = list(range(-1, n))
        agenda = [(place, i, i + 2) for i in range(n - 1) if (place := place_of(text[i : i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, end = heapq.heappop(agenda)
            middle = stop[i]
            if not 0 < middle < end or stop[middle] != end:
                continue
            stop[i], stop[middle], start[end] = end, 0, i
            if end < n:
                place = place_of(text[i : stop[end]])
                if place is not None:
                    heapq.heappush(agenda, (place, i, stop[end]))
            if i:
                place = place_of(text[start[i] : end])
                if place is not None:
                    heapq.heappush(agenda, (place, start[i], end))
        out, i = [], 0
        while i < n:
            out.append(text[i : stop[i]])
            i = stop[i]
        return out

    def _encode_part(self, part: str) -> bytes:
        """Ids of one part as int32 bytes."""
        found = self._ids.get
        ids: list[int] = []
        for piece in self._merged(part):
            known = found(piece)
            if known is not None:
                ids.append(known)
            elif self._fallback:
                ids += [self._bytes[b] for b in piece.encode("utf-8")]
            else:
                ids.append(self._unknown)
        return array("i", ids).tobytes()

    def _of_parts(self, normal: str) -> np.ndarray:
        """Ids of a normalised text."""
        ids = np.frombuffer(b"".join(map(self._known.__getitem__, self._part.findall(normal))), np.int32)
        return ids if self._fallback else self._one_unknown(ids)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; a null text is empty."""
        return self._of_parts(self.library.normalize(text) if text else "")

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of whole texts, each part of them that is new here checked against the library."""
        out = [self.encode(t) for t in texts]
        self.check_fresh()
        self._known.age()
        return out

    def check_fresh(self) -> None:
        """Compare with the library on one text of all parts met since the last check, each on a line of its own."""
        fresh, self._known.fresh = self._known.fresh, []
        if fresh:
            text = "\n".join(["", *fresh]).replace(SPACE, " ")
            own = self.encode(text)
            self._known.fresh = []
            if not np.array_equal(own, self.library.encode(text)):
                raise RuntimeError(f"ids of {text[:200]!r} differ from the library's")

    def _one_unknown(self, ids: np.ndarray) -> np.ndarray:
        """Without byte pieces a run of unknown characters is a single unknown piece."""
        again = np.zeros(len(ids), bool)
        again[1:] = (ids[1:] == self._unknown) & (ids[:-1] == self._unknown)
        return ids[~again]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids: spaces for marks, none for the one put before the text, U+FFFD for each byte outside UTF-8."""
        surface = self._surface
        parts = [surface[i] for i in ids.tolist()]
        if self._strip and parts:
            stays = self._stays[ids]
            at, going = 0, True
            while at < len(parts) and going and not stays[at]:
                spaces = parts[at].startswith(b" ")
                parts[at] = parts[at][1:] if spaces else parts[at]
                # A control piece adds nothing, so the text still begins behind it.
                going = not parts[at] and (not spaces or self._strip_all)
                at += 1
        if self._control[ids].any():
            return "".join(map(_decoded, self._runs(parts, ids)))
        return _decoded(b"".join(parts))

    def _runs(self, parts: list[bytes], ids: np.ndarray) -> Iterator[bytes]:
        """Stretches between control pieces; bytes on both sides of one don't make a character."""
        bounds = [0, *(np.flatnonzero(self._control[ids]) + 1).tolist(), len(parts)]
        return (b"".join(parts[a:b]) for a, b in zip(bounds, bounds[1:], strict=False))


def _decoded(data: bytes) -> str:
    """UTF-8 with U+FFFD for every single byte that starts no whole character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode("utf-8"))
            break
        except UnicodeDecodeError as bad:
            out.append(data[at : at + bad.start].decode("utf-8") + "�")
            at += bad.start + 1
    return "".join(out)


@functools.lru_cache(maxsize=2)
def _loaded(path: str) -> PieceBpe:
    """One encoder for all tasks of a worker, with what it remembers."""
    with open(path, "rb") as f:
        return PieceBpe(f.read())


def piece_encode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """(doc_id, ids[, decoded]) of every whole text.

    Batch by batch, all parts that a task has not met before are encoded by
    the library as well; a difference is an error. A null text counts as
    empty: no ids, decoded "". Repeated rows and null ids give a row each,
    and equal texts equal ids; very long texts go whole, one by one; further
    columns, whatever their names, are left out; an empty table gives an
    empty result. ``model_path`` names a file that driver and executors share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(model_path)
        for batch in steps(batches, "text"):
            ids = bpe.encode_batch(batch.column(1).to_pylist())
            out = {"doc_id": batch.column(0), "ids": _lists(ids)}
            if decoded:
                out["decoded"] = pa.array([bpe.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, ids array<int>" + ", decoded string" * decoded)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    """An Arrow list per row, without a Python object per id."""
    bounds = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(rows) if rows else np.empty(0, np.int32)))


def piece_decode(encoded: DataFrame, model_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) of id lists; a null list gives an empty text, an id outside the vocabulary is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(model_path)
        for batch in batches:
            texts = [bpe.decode(np.array(x or [], np.int32)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    lists = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return lists.mapInArrow(run, "doc_id long, decoded string")


def piece_digests(encoded: DataFrame, *carried: str) -> DataFrame:
    """Number of tokens and SHA-256 of ids (joined by commas) and decoded text."""
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *carried,
    )
