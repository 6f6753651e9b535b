"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last 16 characters cuts texts into chunks of about ``2 ** CUT_BITS`` characters, so passages that documents share
fall into equal chunks.  Of each chunk the part between its first and last blank is encoded once per worker and reused; what lies
around a cut (tail of one chunk, head of the next) is encoded again as a whole, growing over further chunks until both of
its ends are blanks, where tokens cannot span.  A chunk not met before is put together from its blank-separated pieces, which
are reused the same way.  All caches are bounded; what they have forgotten is encoded again, so they never change a result.

Requirements on the tokenizer: no token spans a space or line feed, and decoding joins the tokens' texts by spaces.  ``Coder`` checks both.

Defined results: a null text is an empty one; it has no tokens and decodes to ''.  Rows are coded one by one, repeated rows alike, null
ids are kept, extra columns are ignored.  The length of a text or of a piece is not limited.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CUT_BITS = 9
#: Cached pieces (in each of two generations) and chunks per worker: some 90 MB and 10 MB.  Longer pieces are encoded anew.
PIECES, PIECE_CHARS, CHUNKS = 220_000, 48, 5_000
#: Texts handed back at once.
ROWS_OUT = 400


def cuts(text: str, bits: int = CUT_BITS) -> list[int]:
    """Positions where the rolling hash of the 16 characters before them has ``bits`` zero bits."""
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    for width in (1, 2, 4, 8):
        if len(h) <= width:
            return []
        h[width:] += h[:-width] << np.uint32(width)  # numpy copies what overlaps
    return (np.flatnonzero((h >> np.uint32(32 - bits)) == 0) + 1).tolist()


class Pieces(dict):
    """Ids of blank-separated pieces, packed; a piece that is not cached is encoded when asked for."""

    def __init__(self, tokenizer) -> None:
        super().__init__({"": b""})
        self.tokenizer, self.older = tokenizer, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        if len(piece) <= PIECE_CHARS:
            if len(self) > PIECES:  # what is still in use comes back from the older half
                self.older = dict(self)
                self.clear()
                self[""] = b""
            self[piece] = ids
        return ids


class Coder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        names = [tokenizer.id_to_token(i) for i in range(size)]
        self.names = np.array(names, dtype=object)
        self.pieces, self.chunks = Pieces(tokenizer), {}
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are packed as little-endian 32-bit integers")
        if self.pieces["a b"] != self.pieces["a"] + self.pieces["b"]:
            raise ValueError("tokens of this tokenizer span blanks")
        if None in names or tokenizer.decode(list(range(size)), skip_special_tokens=False) != " ".join(names):
            raise ValueError("this tokenizer does not decode to its tokens' texts, joined by spaces")

    def closed(self, text: str) -> bytes:
        """Encode what is bounded by blanks."""
        return b"".join(map(self.pieces.__getitem__, text.split(" ")))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.  ``text`` has spaces for line feeds."""
        out: list[bytes] = []
        rest, begin = "", 0  # text of the join that is still open
        for end in [*cuts(text), len(text)]:
            chunk = text[begin:end]
            begin = end
            first, last = chunk.find(" "), chunk.rfind(" ")
            if first < 0:
                rest += chunk
                continue
            out.append(self.closed(rest + chunk[:first]))
            rest = chunk[last + 1:]
            inner = chunk[first:last]
            known = self.chunks.get(inner)
            if known is None:
                if len(self.chunks) >= CHUNKS:
                    self.chunks.clear()
                known = self.chunks[inner] = self.closed(inner)
            out.append(known)
        out.append(self.closed(rest))
        return b"".join(out)

    def forget(self) -> None:
        """Empty the caches."""
        self.pieces, self.chunks = Pieces(self.pieces.tokenizer), {}

    def decode(self, ids: bytes) -> str:
        return " ".join(self.names[np.frombuffer(ids, dtype="<u4")].tolist())


@lru_cache(maxsize=1)
def coder(path: str) -> Coder:
    """One per worker process, so that caches can outlive a task."""
    return Coder(path)


def encode(docs: DataFrame, path: str, forget: bool = False) -> DataFrame:
    """(doc_id, ids: binary, decoded: string); ``path`` names the tokenizer file on every executor.

    With ``forget`` a task leaves no caches behind in its worker, for jobs whose other stages need the memory.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = coder(path)
        try:
            for batch in batches:
                for i in range(0, len(batch), ROWS_OUT):
                    part = batch.iloc[i:i + ROWS_OUT]
                    texts = [(t or "").replace("\n", " ") for t in part["text"]]
                    ids = [own.encode(t) for t in texts]
                    yield pd.DataFrame({"doc_id": part["doc_id"].array, "ids": ids, "decoded": [own.decode(i) for i in ids]})
        finally:
            if forget:
                own.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, ids binary, decoded string")


def digests(docs: DataFrame, path: str, keep_ids: bool = False, forget: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of every row."""
    return encode(docs, path, forget).select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), *["ids"] * keep_ids)
