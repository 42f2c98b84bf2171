"""Scoring a stream with a model trained beforehand: stateless, one job per batch."""

from __future__ import annotations

from pyspark.ml.base import Model
from pyspark.sql import DataFrame

from tideline.functions.parsing import (
    clean_lines, parse_keyed_csv, parse_label_space, parse_libsvm, to_vector,
)
from tideline.operators.models import score

PARSERS = {"label_space": parse_label_space, "keyed_csv": parse_keyed_csv}
FORMS = [*PARSERS, "libsvm"]


def score_stream(model: Model, lines: DataFrame, form: str) -> DataFrame:
    """Parse lines of a given form and add ``prediction``.

    ``form``: ``label_space`` (``label,f f f``), ``keyed_csv`` (``id,f,f``) or
    ``libsvm`` (comments and blank lines dropped). The vector width is the
    model's, so a batch without the last features scores all the same.
    """
    if form == "libsvm":
        parsed = to_vector(parse_libsvm(clean_lines(lines)), model.numFeatures)
    elif form in PARSERS:
        parsed = PARSERS[form](lines)
    else:
        raise ValueError(f"unknown line form: {form}")
    return score(model, parsed)
