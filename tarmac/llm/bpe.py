"""Byte-level BPE with content-defined chunk reuse.

A text is cut where a rolling hash of eight bytes hits a pattern, so equal
passages in different documents are cut alike.  A cut is widened to the
nearest places where a token must end whatever stands around it (between a
letter and a space that is followed by a letter: the pre-tokenizer always
splits there).  The piece between two widened cuts is encoded once for all
documents of a task that hold it.  The stretch inside a widened cut, the joint,
is encoded from its own bytes, and a cut without such places on either side is
given up, so that its neighbours are encoded as one piece.  The pieces' ids
then follow one another exactly as if the whole text had been encoded.

Pieces of plain letters, digits and punctuation go through the ranks of the
same vocabulary; any other piece, and one with a very long run of white space,
goes through the tokenizers library itself.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .registry import query

VOCABULARY = "byte_bpe_50k.json"
#: a chunk has about this many bytes
CHUNK = 1 << 9
#: bytes of pieces that a task keeps for reuse before it starts anew
HELD_BYTES = 24 << 20
#: the ranks' pattern matcher overflows on about a million white-space characters in a row; pieces with such a run, or
#: a tenth of it, go through the library
LONG_SPACE = 100_000
_SPACE = re.compile(r"\s+")
_PLAIN = re.compile(r"[\x20-\x7E\n\r\tÀ-ÖØ-öø-ÿ]*\Z")
#: fixed pattern of the pre-tokenizer
_SPLIT = (r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def _byte_letters() -> dict[str, int]:
    """The vocabulary file writes printable bytes as themselves and the others as letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return letters


class ChunkedBpe:
    """Encodes texts to the ids of the tokenizers library and decodes them again."""

    def __init__(self, path: str, chunk: int = CHUNK):
        import tiktoken
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items()
                 if word not in self.special}
        self.fast = tiktoken.Encoding("byte-bpe", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        self.cuts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.mask = np.uint64(chunk - 1)
        self.pieces: dict[str, tuple[int, str, bytes]] = {}
        self.held = 0

    def _encode(self, piece: str) -> tuple[int, str, bytes]:
        """(number of ids, ids joined by commas, decoded bytes) of a piece; kept for reuse."""
        found = self.pieces.get(piece)
        if found is None:
            if _PLAIN.match(piece) and not (len(piece) >= LONG_SPACE
                                            and any(m.end() - m.start() >= LONG_SPACE for m in _SPACE.finditer(piece))):
                ids = self.fast.encode_ordinary(piece)
            else:
                ids = self.library.encode(piece, add_special_tokens=False).ids
            found = len(ids), ",".join(map(str, ids)), b"".join(map(self.bytes_of.__getitem__, ids))
            self.held += 8 * len(piece) + 200
            if self.held > HELD_BYTES:
                self.pieces.clear()
                self.held = 8 * len(piece) + 200
            self.pieces[piece] = found
        return found

    def split(self, raw: bytes) -> Iterator[bytes]:
        """Pieces of a text without special tokens: chunk cores and the joints between them."""
        n = len(raw)
        if n < 64:
            yield raw
            return
        b = np.frombuffer(raw, dtype=np.uint8)
        window = np.ndarray(shape=(n - 7,), dtype="<u8", buffer=raw, strides=(1,))
        hits = np.flatnonzero(((window * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) & self.mask == 0) + 7
        letter = ((b | 32) >= 97) & ((b | 32) <= 122)
        sure = np.flatnonzero(letter[:-2] & (b[1:-1] == 32) & letter[2:]) + 1
        at = 0
        if len(sure):
            left = np.searchsorted(sure, hits, side="right") - 1
            right = np.searchsorted(sure, hits, side="left")
            for lo, hi in zip(left.tolist(), right.tolist()):
                if lo < 0 or hi >= len(sure) or sure[lo] < at:
                    continue   # no certain place on one side, or the cut lies inside the joint before it
                if sure[lo] > at:
                    yield raw[at:sure[lo]]
                if sure[hi] > sure[lo]:
                    yield raw[sure[lo]:sure[hi]]
                at = int(sure[hi])
        if at < n:
            yield raw[at:]

    def encode(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids joined by commas, decoded text)."""
        count, ids, out = 0, [], []
        for part in self.cuts.split(text) if self.cuts else [text]:
            if part in self.special:
                token = self.special[part]
                found = [(1, str(token), self.bytes_of[token])]
            else:
                found = [self._encode(p.decode()) for p in self.split(part.encode())]
            for n, joined, raw in found:
                if n:
                    count += n
                    ids.append(joined)
                    out.append(raw)
        return count, ",".join(ids), b"".join(out).decode("utf-8", "replace")


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> ChunkedBpe:
    """One encoder per Python worker."""
    return ChunkedBpe(path)


def _digests(frames, path):
    def sha(s: str) -> str:
        return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()

    bpe = encoder(path or vocabulary_path())
    for pdf in frames:
        rows = [bpe.encode(t or "") for t in pdf["text"]]
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": [r[0] for r in rows],
                            "ids_sha256": [sha(r[1]) for r in rows], "decoded_sha256": [sha(r[2]) for r in rows]})


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def token_ids(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (array of int), decoded text."""
    def run(frames):
        bpe = encoder(path or vocabulary_path())
        for pdf in frames:
            rows = [bpe.encode(t or "") for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"],
                                "ids": [[int(i) for i in r[1].split(",") if i] for r in rows],
                                "decoded": [r[2] for r in rows]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, ids array<int>, decoded string")


def token_digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null counts as the empty text, which has no ids.  The text of a special
    token is that token, as the library has it.  Rows are independent: repeats
    and null ids stay as they are, other columns are ignored, and an empty
    table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(lambda frames: _digests(frames, path),
                            "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op9_chunked_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
