"""SentencePiece encoding that keeps offsets, and decoding.

Every text is normalised by longest prefixes of the model's compiled character
map with its source alignment, segmented, and every piece projected to its byte
span in the original text (``piece_model``). One pass over the rows, no shuffle:
a task holds its model and at most ``CHUNK_BYTES`` of texts (or one text) besides
the Arrow batch.

Defined results: a NULL text counts as empty (begin and end ids only); very long
texts are encoded whole; repeated rows each get the same result; an empty table
gives no rows; extra columns pass through, clashing names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.piece_model import Encoder
from costlake.llm.text import packed, text_of

CHUNK_BYTES = 1 << 20
OUT = ("ids", "spans", "decoded")


@lru_cache(maxsize=2)
def _encoder(model: bytes, bos: bool, eos: bool) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(model, bos, eos)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """UTF-8 texts in lists of at most ``limit`` bytes, or one text."""
    held, size = [], 0
    for t in texts.cast(pa.binary()):
        t = t.as_py()
        if held and size + len(t) > limit:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def encode(docs: DataFrame, model: bytes, text: str = "text", bos: bool = True, eos: bool = True,
           decoded: bool = True, drop_text: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (little-endian unsigned 32-bit integers), ``spans``
    (begin and end byte of each id in the text, likewise) and ``decoded`` (the
    text of the ids). ``model`` is the content of a model file."""
    kinds = "ids binary, spans binary" + (", decoded string" if decoded else "")

    @F.arrow_udf(kinds)
    def run(texts: pa.Array) -> pa.Array:
        encoder = _encoder(model, bos, eos)
        ids, spans, back = [], [], []
        for part in chunks(texts):
            got = encoder(part)
            ids += [i.tobytes() for i, _ in got]
            spans += [s.tobytes() for _, s in got]
            if decoded:
                back += encoder.decode([i for i, _ in got])
        cols = [pa.array(ids, pa.binary()), pa.array(spans, pa.binary())]
        names = ["ids", "spans"]
        if decoded:
            cols, names = [*cols, pa.array(back, pa.string())], [*names, "decoded"]
        return pa.StructArray.from_arrays(cols, names)

    out = docs.select(packed(docs, (*OUT, text) if drop_text else OUT), run(text_of(text)).alias("_got"))
    return out.select("_doc.*", "_got.*")


def read_model(path: str) -> bytes:
    """A model file on the driver; its bytes travel with the tasks."""
    with open(path, "rb") as f:
        return f.read()
