"""Table layouts and source settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from . import fixed


IDS = T.ArrayType(T.IntegerType())


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
LINES = _schema(file=_TEXT, line_no=_LONG, line=_TEXT)
DOCS = _schema(doc_id=_LONG, source=_TEXT, text=_TEXT)
INSTRUCT = _schema(rec_id=_LONG, source=_TEXT, instruction=_TEXT, input=_TEXT, output=_TEXT)
MIXED = _schema(source=_TEXT, doc_id=_LONG, copy_no=_INT, formatted=_TEXT)
VOCAB = _schema(id=_INT, piece=_TEXT, kind=_TEXT)
MERGES = _schema(rank=_INT, left=_TEXT, right=_TEXT)
TOKENS = _schema(doc_id=_LONG, ids=IDS)
SHARD_DOCS = _schema(shard=_TEXT, start=_LONG, ids=IDS)
PACKED = _schema(epoch=_INT, row_id=_LONG, batch_id=_LONG, input_ids=IDS, labels=IDS)
TELEMETRY = _schema(run_id=_LONG, step=_LONG, ts=T.TimestampType(), loss=T.DoubleType(), tokens=_LONG)


@dataclass(frozen=True)
class SourceSpec:
    """How one source enters the mix.

    ``kind`` is book, wiki, web, synthetic, chat or code; ``cap_on`` says whether a cap counts
    rows as they arrive (``input``) or rows that pass the raw filters (``eligible``).
    """

    source: str
    kind: str
    cap: int | None = None
    cap_on: str = "input"
    upsample: int = 1


DEFAULT_SPECS = [
    SourceSpec("books", "book", upsample=fixed.UPSAMPLE_BOOK),
    SourceSpec("chat", "chat", upsample=fixed.UPSAMPLE_CHAT),
    SourceSpec("code", "code", cap=fixed.CAP_CODE, cap_on="eligible"),
    SourceSpec("wiki", "wiki"),
    SourceSpec("synthetic", "synthetic", cap=fixed.CAP_SYNTHETIC),
    SourceSpec("web", "web", cap=fixed.CAP_WEB, cap_on="eligible"),
]
