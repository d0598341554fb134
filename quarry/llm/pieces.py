"""SentencePiece encoding and decoding over a distinct-chunk table.

Where no piece of the vocabulary has a whitespace marker after another
character, pieces cannot cross from one marked word into the next: a text's ids
are the ids of its chunks (a run of markers and what follows up to the next
run), one after the other.  Each task keeps a table of the distinct chunks it
has met, segments each of them once, and joins ids (or decoded text) back by
position.  Beyond ``TABLE`` chunks the table starts anew, so
memory does not grow with the vocabulary of the corpus; a table for the whole
corpus would have to be joined to every word of it through a shuffle.

Models whose pieces cross markers, or that normalise texts, get whole texts as
their only chunks: same results, no saving.

Null text is empty; an empty text has begin and end ids only.  Repeated rows,
null ids and extra columns pass through as they are.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import slices

if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are kept as native 32-bit integers, which have to be little-endian")

TABLE = 300_000             # chunks a task keeps at most, about (some 100 MB)
MARK = "▁"
_RUN = re.compile(" ( *[^ ]*)")
_PROBE = "ﬁ Ａ  é　\t a "


class Codec:
    """Encoder and decoder of one model with a table of its distinct chunks."""

    def __init__(self, model_file: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        names = (self.model.id_to_piece(i) for i in range(self.model.vocab_size()))
        crossing = any(MARK in name.lstrip(MARK) for name in names)
        plain = self.model.normalize(_PROBE) == MARK + _PROBE.replace(" ", MARK)
        self.separable = plain and not crossing
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}
        self.begin = array("I", [self.model.bos_id()]).tobytes()
        self.end = array("I", [self.model.eos_id()]).tobytes()

    def chunks(self, text: str) -> list[str]:
        """The text's chunks without their first marker (the encoder adds one
        to whatever it is given); a lone marker is the empty chunk."""
        if not text:
            return []
        if not self.separable:
            return [text]
        text = text.replace(MARK, " ")
        if text[0] != " " and "  " not in text:
            return text.split(" ")
        return _RUN.findall(" " + text)

    def learn(self, chunks: set[str], decoded: bool = True) -> None:
        """Segment the chunks that the table does not hold; ``decoded``: and keep
        what their ids decode to."""
        known = self.texts if decoded else self.ids
        new = sorted(c for c in chunks if c not in known)
        if len(self.ids) > TABLE:
            self.ids, self.texts, new = {}, {}, sorted(chunks)
        lone = self.model.piece_to_id(MARK)
        found = [ids if chunk or not self.separable else [lone]
                 for chunk, ids in zip(new, self.model.encode(new, num_threads=1) if new else [], strict=True)]
        if not new:
            return
        self.ids.update(zip(new, (array("I", ids).tobytes() for ids in found), strict=True))
        if decoded:
            self.texts.update(zip(new, self.model.decode(found, num_threads=1), strict=True))

    def encode(self, chunks: list[str]) -> bytes:
        """All ids with begin and end, as little-endian unsigned 32-bit integers."""
        return self.begin + b"".join([self.ids[c] for c in chunks]) + self.end

    def decode(self, chunks: list[str]) -> str:
        """The text that the ids of these chunks decode to."""
        return " ".join([self.texts[c] for c in chunks])


@lru_cache(maxsize=4)
def codec(model_file: str) -> Codec:
    """The codec of this worker process."""
    return Codec(model_file)


GROUP = 2_000_000           # characters whose new chunks are segmented together


def _groups(texts: list[str]):
    """Runs of rows of about ``GROUP`` characters."""
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= GROUP:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _encoded(model_file: str, text_at: int, ids_out: bool):
    def run(batches):
        own = codec(model_file)
        for batch in slices(batches, text_at):
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            others = [batch.column(i) for i in range(batch.num_columns) if i != text_at]
            names = [batch.schema.names[i] for i in range(batch.num_columns) if i != text_at]
            for lo, hi in _groups(texts):
                parts = [own.chunks(t) for t in texts[lo:hi]]
                own.learn({c for p in parts for c in p}, decoded=not ids_out)
                ids = [own.encode(p) for p in parts]
                count = pa.array([len(b) // 4 for b in ids], pa.int64())
                kept = [o.slice(lo, hi - lo) for o in others]
                if ids_out:
                    flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                    ends = np.concatenate([[0], np.cumsum([len(b) // 4 for b in ids])])
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([*kept, count, lists], [*names, "n_tokens", "ids"])
                else:
                    decoded = [hashlib.sha256(own.decode(p).encode()).hexdigest() for p in parts]
                    yield pa.RecordBatch.from_arrays(
                        [*kept, count, pa.array([hashlib.sha256(b).hexdigest() for b in ids]), pa.array(decoded)],
                        [*names, "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids): every whole text with begin and end ids."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(_encoded(model_file, 1, True), "doc_id long, n_tokens long, ids array<int>")


def digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): hashes of the ids and of the
    text they decode to."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(_encoded(model_file, 1, False),
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
