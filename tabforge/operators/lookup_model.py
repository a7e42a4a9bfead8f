"""Models that look up their own features.

The steps that turn a request (key + whatever the caller knows) into model
inputs are pipeline stages themselves: lookups in feature tables, SQL
function features, left-out columns, the policy for missing numbers. They are
saved and loaded with the fitted model as one ``PipelineModel``, so scoring
rejoins the features by the stored recipe, in any later session, with the
same code as training.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.names import qualified_name
from tabforge.operators.clean import require_columns
from tabforge.operators.encode import fill_for_trees
from tabforge.operators.lookup import Lookup, feature_lookup
from tabforge.operators.model import train_gbt
from tabforge.spec import FeatureSpec

# Share of a request's rows from which a key's features are broadcast.
HOT_KEY_FRACTION = 0.01


def _param(name: str, doc: str, converter) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=converter)


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose parameters are all of its state."""

    def value(self, name: str):
        return self.getOrDefault(name)


class TableLookup(_Stage):
    """Looks ``features`` up in the catalog table ``table`` by ``key``.

    Unmatched and NULL keys get NULLs; a repeated key in the table fails the
    query; a feature that the input already has is an error.
    """

    table = _param("table", "qualified name of the feature table", TypeConverters.toString)
    key = _param("key", "lookup key, of the same name on both sides", TypeConverters.toString)
    features = _param("features", "looked-up columns", TypeConverters.toListString)
    outputs = _param("outputs", "their names on the output", TypeConverters.toListString)

    @keyword_only
    def __init__(self, table: str | None = None, key: str | None = None, features: Sequence[str] | None = None,
                 outputs: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.value("features")
        out = self.value("outputs") if self.isSet("outputs") else names
        table = df.sparkSession.table(qualified_name(*self.value("table").split(".")))
        return feature_lookup(df, Lookup(table, tuple(names), self.value("key"), dict(zip(names, out))),
                              hot_key_fraction=HOT_KEY_FRACTION)


class SqlFunctionFeature(_Stage):
    """Adds ``output`` = a SQL function of input columns.

    The function's text is part of the stage: it is defined (as a temporary
    function ``name``) in whatever session the stage runs in.
    """

    name = _param("name", "function name", TypeConverters.toString)
    arguments = _param("arguments", "argument declarations, such as 'year_built INT'", TypeConverters.toString)
    returns = _param("returns", "result type", TypeConverters.toString)
    body = _param("body", "SQL expression of the arguments", TypeConverters.toString)
    inputs = _param("inputs", "input columns bound to the arguments, in order", TypeConverters.toListString)
    output = _param("output", "name of the new column", TypeConverters.toString)

    @keyword_only
    def __init__(self, name: str | None = None, arguments: str | None = None, returns: str | None = None,
                 body: str | None = None, inputs: Sequence[str] | None = None, output: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def define(self, spark) -> str:
        name = qualified_name(self.value("name"))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({self.value('arguments')}) "
                  f"RETURNS {self.value('returns')} RETURN {self.value('body')}")
        return name

    def _transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.value("inputs"))
        if self.value("output") in df.columns:
            raise ValueError(f"function output already present on input: {self.value('output')!r}")
        return df.withColumn(self.value("output"), F.call_function(self.define(df.sparkSession),
                                                                  *[F.col(c) for c in self.value("inputs")]))


class DropColumns(_Stage):
    """Leaves ``columns`` out where they are present."""

    columns = _param("columns", "columns to leave out", TypeConverters.toListString)

    @keyword_only
    def __init__(self, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.value("columns"))


class TreeNumbers(_Stage):
    """Numbers as doubles, missing ones as the fixed value that trees take for missing."""

    columns = _param("columns", "numeric model inputs", TypeConverters.toListString)

    @keyword_only
    def __init__(self, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return fill_for_trees(df, self.value("columns"))


def age_feature(year_col: str, output: str = "house_age", as_of_year: int | None = None,
                name: str = "house_age_of") -> SqlFunctionFeature:
    """Reference year minus ``year_col`` (the query's current year by default)."""
    ref = str(int(as_of_year)) if as_of_year is not None else "year(current_date())"
    return SqlFunctionFeature(name=name, arguments="year_built INT", returns="INT",
                              body=f"CAST({ref} - year_built AS INT)", inputs=[year_col], output=output)


def assemble(df: DataFrame, stages: Sequence[Transformer]) -> DataFrame:
    """The request with everything the recipe adds."""
    for s in stages:
        df = s.transform(df)
    return df


def fit_lookup_model(train: DataFrame, spec: FeatureSpec, lookups: Sequence[TableLookup],
                     functions: Sequence[SqlFunctionFeature] = (), exclude: Sequence[str] = (),
                     params: Mapping[str, object] | None = None, seed: int = 42, folder: str | None = None,
                     held_out: Column | None = None) -> PipelineModel:
    """Fit a model on ``train`` (key, label, known columns) through its lookups.

    ``spec`` names the model's inputs after assembly: looked-up, computed and
    the caller's own columns. The result scores frames with the same columns
    as ``train`` but the label.
    """
    if clash := [c for c in exclude if c in (*spec.num, *spec.cat, spec.target)]:
        raise ValueError(f"excluded columns are model inputs: {clash}")
    recipe = [*lookups, *functions, DropColumns(columns=list(exclude))]
    rows = assemble(train, recipe)
    require_columns(rows, [spec.id_col, *spec.num, *spec.cat, spec.target])
    fitted = train_gbt(rows, spec, params, seed, folder, held_out)
    return PipelineModel([*recipe, TreeNumbers(columns=list(spec.num)), *fitted.stages])


def request_columns(train: DataFrame, spec: FeatureSpec, model: PipelineModel) -> list[str]:
    """What a request must have: the keys and the inputs that no stage adds."""
    added, keys, bound = set(), [], []
    for s in model.stages:
        if isinstance(s, TableLookup):
            added |= set(s.value("outputs") if s.isSet("outputs") else s.value("features"))
            keys.append(s.value("key"))
        elif isinstance(s, SqlFunctionFeature):
            added.add(s.value("output"))
            bound += s.value("inputs")
    wanted = dict.fromkeys([spec.id_col, *keys, *bound, *spec.num, *spec.cat])
    return [c for c in wanted if c not in added and c in train.columns]


def recipe_text(model: PipelineModel) -> list[str]:
    """One readable line per stage that the model adds features with."""
    out = []
    for s in model.stages:
        if isinstance(s, TableLookup):
            out.append(f"lookup {', '.join(s.value('features'))} in {s.value('table')} by {s.value('key')}")
        elif isinstance(s, SqlFunctionFeature):
            body = re.sub(r"\s+", " ", s.value("body"))
            out.append(f"{s.value('output')} = {s.value('name')}({', '.join(s.value('inputs'))}) as {body}")
    return out
