"""Completions (G1-G4): attach one completion per prompt (and sample).

No model client ships with the library.  A completion source is either a
table keyed by ``prompt_id`` (joined), or a user callable run batch-wise with
``mapInPandas`` (Arrow batches, one call per batch of prompts).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holecard.functions.text import col

# --- fixed values: request parameters of the reference run ---
STOP_SEQUENCE = "\n\n\n"
DEFAULT_PARAMS = {"model": "codellama/7b", "temperature": 0.2, "top_p": 0.95,
                  "times": 1, "max_tokens": 256}


def params_struct(params: dict | None = None) -> Column:
    """The request parameters as one struct column (recorded beside results)."""
    p = {**DEFAULT_PARAMS, **(params or {})}
    return F.struct(F.lit(p["model"]).alias("model"),
                    F.lit(float(p["temperature"])).alias("temperature"),
                    F.lit(float(p["top_p"])).alias("top_p"),
                    F.lit(int(p["times"])).alias("times"),
                    F.lit(int(p["max_tokens"])).alias("max_tokens"))


def stop_cut(completion, stop: str = STOP_SEQUENCE) -> Column:
    """Cut a completion at the first stop sequence."""
    return F.substring_index(col(completion), stop, 1)


def expand_samples(prompts: DataFrame, times: int) -> DataFrame:
    """``times`` rows per prompt, numbered by ``sample_idx``; none for 0."""
    numbers = F.filter(F.sequence(F.lit(0), F.lit(max(times, 1) - 1)), lambda i: i < times)
    return prompts.withColumn("sample_idx", F.explode(numbers))


def complete_with(prompts: DataFrame, completer: Callable[[pd.DataFrame], pd.Series],
                  stop: str | None = STOP_SEQUENCE) -> DataFrame:
    """G1: run ``completer`` on Arrow batches of prompt rows; add ``completion``.

    ``completer`` gets a pandas DataFrame of prompt rows and returns one
    string per row.  Spark decides the batching and the parallelism; the
    callable sees no more than one Arrow batch at a time.
    """
    schema = T.StructType(prompts.schema.fields + [T.StructField("completion", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf.copy()
            out["completion"] = pd.Series(completer(pdf), index=pdf.index).astype(object)
            yield out

    done = prompts.mapInPandas(run, schema)
    return done.withColumn("completion", stop_cut("completion", stop)) if stop else done


def attach_completions(prompts: DataFrame, completions: DataFrame,
                       key: list[str] | None = None) -> DataFrame:
    """G1 (table form): equi-join completions on the prompt key, never by position."""
    return prompts.join(completions, key or ["prompt_id"], "inner")


def previous_line_completer(pdf: pd.DataFrame) -> pd.Series:
    """Deterministic stand-in model: repeat the last line of the prompt prefix."""
    prefix = pdf["prompt"].fillna("").str.split(" <SUF>", n=1, regex=False).str[0]
    prefix = prefix.str.removeprefix("<PRE> ")
    return prefix.str.extract(r"([^\n]*\n?)\Z", expand=False).fillna("")


previous_line_completer.deterministic = True
