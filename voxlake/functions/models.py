"""User models as partition-level functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def apply_model(rows: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], outputs: T.StructType) -> DataFrame:
    """All rows with the model's output columns, success and error.

    load runs once in each task, when its first batch comes. The model gets a batch of rows and returns as many,
    in order. If a batch fails, its rows are tried one by one; a row that fails keeps its place with null outputs
    and the error's text. A batch stays one batch of output. No row is lost and none is made up."""
    names = [f.name for f in outputs]
    schema = T.StructType([*rows.schema.fields, *outputs.fields, T.StructField("success", T.BooleanType()), T.StructField("error", T.StringType())])

    def checked(model: Callable, batch: pd.DataFrame) -> pd.DataFrame:
        out = model(batch)[names]
        if len(out) != len(batch):
            raise ValueError(f"the model returned {len(out)} rows for {len(batch)}")
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            model = model or load()
            try:
                out, errors = checked(model, batch), None
            except Exception:  # noqa: BLE001  the rows of a failed batch are told apart
                values, errors = {n: [None] * len(batch) for n in names}, [None] * len(batch)
                for i in range(len(batch)):
                    try:
                        row = checked(model, batch.iloc[i : i + 1])
                        for n in names:
                            values[n][i] = row[n].iat[0]
                    except Exception as e:  # noqa: BLE001
                        errors[i] = f"{type(e).__name__}: {e}"
                out = pd.DataFrame({n: pd.Series(v, dtype="object") for n, v in values.items()})
            yield pd.concat([batch, out.set_axis(batch.index)], axis=1).assign(success=True if errors is None else [e is None for e in errors], error=errors)

    return rows.mapInPandas(run, schema)
