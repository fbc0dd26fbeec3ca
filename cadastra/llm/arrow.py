"""Row-wise scoring of whole texts over Arrow batches: no shuffle, bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm.held import held


def score_texts(docs: DataFrame, keep: list, text: str, out: str, make: Callable[[], Callable[[str], tuple]]) -> DataFrame:
    """The columns `keep` with those of the schema string `out`, which make()() gives for each text (null: empty).

    make runs once in each task, so that what can't be pickled is opened there.
    """
    head = docs.select(*keep)
    added = T.StructType.fromDDL(out)
    schema = T.StructType([*head.schema.fields, *added.fields])
    source = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    n = len(head.columns)
    names = schema.fieldNames()
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[f.dataType.simpleString()] for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(("scores",), dict)  # lets go of what other operators keep
        score = make()
        for batch in batches:
            rows = [score(x.as_py()) for x in batch.column(n)]
            columns = [*(batch.column(i) for i in range(n)), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, schema)
