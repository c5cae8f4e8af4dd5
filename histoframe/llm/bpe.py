"""Byte-pair encoding by forced boundaries, and decoding.

A merge only ever builds tokens of the vocabulary, so two neighbouring bytes
that stand next to each other in no token can never end up in one: between
them the text may be cut for certain. Pieces of the vocabulary's own splitting
pattern are cut there, the fragments are merged independently (each distinct
one once while it is remembered), and their ids are put together again.

Works on files of the ``tokenizers`` library with a byte-level BPE model, a
``Split`` pattern whose matches are the pieces, NFC / lower case
normalisation and an optional word-end suffix. No decoder in the file means
that tokens are joined by one space, as that library does.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoframe.llm.batches import steps

#: Distinct pieces and fragments a task remembers before it starts anew.
_MEMO = 300_000

#: Below this code point NFC changes nothing and lower case is the same by character.
_PLAIN_BELOW = 0x250


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, spare = [], 256
    for byte in range(256):
        if byte in printable:
            symbols.append(chr(byte))
        else:
            symbols.append(chr(spare))
            spare += 1
    return symbols


class _Memo(dict):
    """Ids of pieces as int32 bytes, made on first use."""

    def __init__(self, make) -> None:
        super().__init__()
        self._make = make

    def __missing__(self, key: str) -> bytes:
        out = self[key] = self._make(key)
        return out


class BoundaryBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, spec: str) -> None:
        parts = json.loads(spec)
        model = parts["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self._suffix: str = model["end_of_word_suffix"] or ""
        self._symbols = _byte_symbols()
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self._ranks = {(a, b): (rank, a + b) for rank, (a, b) in enumerate(pairs)}
        self._special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self._specials = re.compile("|".join(map(re.escape, sorted(self._special, key=len, reverse=True)))) if self._special else None
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self._special.items()}
        self._inside = self._pairs_inside_tokens()
        split = next(p for p in parts["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._pattern = regex.compile(split["pattern"]["Regex"].replace("\\s", "\\p{White_Space}"))
        self._spec = spec
        self._library = None
        self._fragments: dict[tuple[str, ...], bytes] = {}
        self._pieces = _Memo(lambda piece: self._encode_symbols("".join([self._symbols[b] for b in piece.encode("utf-8")])))
        self._symbol_pieces = _Memo(self._encode_symbols)

    def _pairs_inside_tokens(self) -> set[str]:
        """Two-symbol strings that stand next to each other in some token."""
        inside = set()
        for token in self.vocab:
            bare = token[: -len(self._suffix)] if self._suffix and token.endswith(self._suffix) else token
            inside.update(map("".join, zip(bare, bare[1:], strict=False)))
        return inside

    def _merge(self, parts: tuple[str, ...]) -> list[int]:
        """Ids of one fragment: lowest rank first, leftmost among equals."""
        symbols: list[str | None] = list(parts)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        end = len(parts)
        queue = [(rank[0], i) for i in range(end - 1) if (rank := self._ranks.get((symbols[i], symbols[i + 1])))]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i] if symbols[i] is not None else end
            known = self._ranks.get((symbols[i], symbols[j])) if j < end else None
            if known is None or known[0] != rank:
                continue
            symbols[i], symbols[j] = known[1], None
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < end and (found := self._ranks.get((symbols[left], symbols[right]))):
                    heapq.heappush(queue, (found[0], left))
        return [self.vocab[s] for s in symbols if s is not None]

    def _encode_fragment(self, parts: tuple[str, ...]) -> bytes:
        ids = self._fragments.get(parts)
        if ids is None:
            ids = self._fragments[parts] = np.array(self._merge(parts), np.int32).tobytes()
        return ids

    def _encode_symbols(self, piece: str) -> bytes:
        symbols = list(piece)
        cuts = [i for i in range(1, len(symbols)) if symbols[i - 1] + symbols[i] not in self._inside]
        symbols[-1] += self._suffix
        bounds = [0, *cuts, len(symbols)]
        return b"".join(self._encode_fragment(tuple(symbols[a:b])) for a, b in zip(bounds, bounds[1:], strict=False))

    def _encode_plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        Beyond the plain characters the library's own normaliser and splitter
        find the pieces, as their tables of letters have a version.
        """
        if not text:
            return b""
        if text.isascii() or ord(max(text)) < _PLAIN_BELOW:
            return b"".join(map(self._pieces.__getitem__, self._pattern.findall(text.lower())))
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self._spec)
        found = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return b"".join([self._symbol_pieces[piece] for piece, _ in found])

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; special tokens spelt out in it are themselves."""
        text = text or ""
        if max(len(self._pieces), len(self._symbol_pieces), len(self._fragments)) > _MEMO:
            for known in (self._pieces, self._symbol_pieces, self._fragments):
                known.clear()
        if self._specials is None or not self._specials.search(text):
            return np.frombuffer(self._encode_plain(text), np.int32)
        out, at = [], 0
        for m in self._specials.finditer(text):
            out += [self._encode_plain(text[at : m.start()]), np.array([self._special[m[0]]], np.int32).tobytes()]
            at = m.end()
        return np.frombuffer(b"".join([*out, self._encode_plain(text[at:])]), np.int32)

    def decode(self, ids: list[int]) -> str:
        """Tokens of the ids, joined by a space; ids outside the vocabulary are skipped."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids if i in tokens])


def _spec(vocab_path: str) -> str:
    with open(vocab_path, encoding="utf-8") as f:
        return f.read()


def bpe_encode(docs: DataFrame, vocab_path: str, *, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """(doc_id, ids[, decoded]) of every whole text.

    A null text counts as empty: no ids, decoded "". Repeated rows and null
    ids give a row each; further columns are left out; an empty table gives
    an empty result. ``vocab_path`` names a file that driver and executors
    share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = BoundaryBpe(_spec(vocab_path))
        for batch in steps(batches, "text"):
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(ids, pa.list_(pa.int32()))]
            names = ["doc_id", "ids"]
            if decoded:
                columns.append(pa.array([bpe.decode(x.tolist()) for x in ids], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, ids array<int>" + ", decoded string" * decoded)


def bpe_decode(encoded: DataFrame, vocab_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) of id lists; a null list gives an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = BoundaryBpe(_spec(vocab_path))
        for batch in batches:
            texts = [bpe.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    lists = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return lists.mapInArrow(run, "doc_id long, decoded string")


def digests(encoded: DataFrame, *carried: str) -> DataFrame:
    """Number of tokens and SHA-256 of ids and decoded text."""
    listed = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *carried,
    )
