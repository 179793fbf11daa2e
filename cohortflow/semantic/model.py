"""Definitions that turn business words into Spark SQL expressions, and how they apply to DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, functions as F

from cohortflow.operators.joins import check_many_to_one
from cohortflow.plans.lineage import stored_once


@dataclass(frozen=True)
class Term:
    """A named SQL expression over one gold table with the words people use for it."""

    name: str
    source: str
    sql: str
    synonyms: Sequence[str] = ()
    description: str = ""


class Measure(Term):
    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.name, F.expr(self.sql))


class NamedFilter(Term):
    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(F.expr(self.sql))


class Dimension(Term):
    def group(self, df: DataFrame) -> GroupedData:
        return df.groupBy(F.expr(self.sql).alias(self.name))


@dataclass(frozen=True)
class JoinSpec:
    """A declared many-to-one join on equally named keys."""

    left: str
    right: str
    keys: Sequence[str]
    description: str = ""

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return check_many_to_one(tables[self.right], self.keys)

    def apply(self, tables: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
        """Left table plus ``columns`` of the right one; left rows without a partner stay."""
        right = tables[self.right].select(*self.keys, *columns)
        return tables[self.left].join(right, list(self.keys), "left")


@dataclass(frozen=True)
class Question:
    """A reusable report: what to select from one table, under which filters, in which order.

    ``measures`` and ``filters`` name terms of the model. ``where`` holds further predicates, which may use
    ``:name`` parameters; ``defaults`` gives their values when the caller names none.
    """

    name: str
    text: str
    source: str
    columns: Sequence[str]
    measures: Sequence[str] = ()
    filters: Sequence[str] = ()
    where: Sequence[str] = ()
    group_by: Sequence[str] = ()
    order_by: Sequence[str] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)
    also_asked: Sequence[str] = ()


@dataclass(frozen=True)
class SemanticModel:
    measures: Sequence[Measure] = ()
    filters: Sequence[NamedFilter] = ()
    dimensions: Sequence[Dimension] = ()
    joins: Sequence[JoinSpec] = ()
    questions: Sequence[Question] = ()
    dictionary_columns: Mapping[str, Sequence[str]] = field(default_factory=dict)
    comments: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def term(self, name: str) -> Term:
        for term in (*self.measures, *self.filters, *self.dimensions):
            if term.name == name:
                return term
        raise KeyError(name)

    def question(self, name: str) -> Question:
        for question in self.questions:
            if question.name == name:
                return question
        raise KeyError(name)

    def sql(self, question: Question) -> str:
        """The question as parametrised Spark SQL; the table is a ``{placeholder}``, values are ``:markers``."""
        selected = [*question.columns, *[f"{self.term(m).sql} AS {m}" for m in question.measures]]
        predicates = [*[self.term(f).sql for f in question.filters], *question.where]
        text = f"SELECT {', '.join(selected)} FROM {{{question.source}}}"
        if predicates:
            text += " WHERE " + " AND ".join(f"({p})" for p in predicates)
        if question.group_by:
            text += " GROUP BY " + ", ".join(question.group_by)
        if question.order_by:
            text += " ORDER BY " + ", ".join(question.order_by)
        return text

    def answer(
        self,
        spark: SparkSession,
        name: str,
        tables: Mapping[str, DataFrame],
        args: Mapping[str, object] | None = None,
        only: Mapping[str, object] | None = None,
    ) -> DataFrame:
        """Run a question. Parameters are bound as values and never become part of the SQL text.

        ``only`` narrows it to values of dictionary columns of its table, such as one drug.
        """
        question, only = self.question(name), dict(only or {})
        if unknown := set(only) - set(self.dictionary_columns[question.source] if only else ()):
            raise KeyError(f"{sorted(unknown)} are no dictionary columns of {question.source}")
        question = replace(question, where=(*question.where, *(f"{c} = :only_{c}" for c in only)))
        bound = {**question.defaults, **(args or {}), **{f"only_{c}": v for c, v in only.items()}}
        return spark.sql(self.sql(question), args=bound or None, **{question.source: tables[question.source]})

    def inventory(self, spark: SparkSession) -> DataFrame:
        """kind, n — how much the model defines."""
        rows = [
            ("tables", len(self.dictionary_columns)),
            ("measures", len(self.measures)),
            ("filters", len(self.filters)),
            ("dimensions", len(self.dimensions)),
            ("joins", len(self.joins)),
            ("questions", len(self.questions)),
            ("rephrased questions", sum(len(q.also_asked) for q in self.questions)),
        ]
        return spark.createDataFrame(rows, "kind string, n int")

    def terms(self, spark: SparkSession) -> DataFrame:
        """(word, kind, name): names and synonyms in lower case."""
        kinds = {"measure": self.measures, "filter": self.filters, "dimension": self.dimensions}
        rows = sorted(
            {
                (word.lower(), kind, term.name)
                for kind, terms in kinds.items()
                for term in terms
                for word in (term.name, *term.synonyms)
            }
        )
        return spark.createDataFrame(rows, "word string, kind string, name string")


def phrases(text: Column, longest: int) -> Column:
    """All runs of 1..``longest`` words of a text, lower case. The text is split once: the runs are taken from a variable."""
    split = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: w != "")

    def runs_of(words: Column, n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, lambda start: F.array_join(F.slice(words, start, n), " "))

    return F.transform(F.array(split), lambda words: F.concat(*[runs_of(words, n) for n in range(1, longest + 1)]))[0]


def resolve_terms(asked: DataFrame, text: str, model: SemanticModel) -> DataFrame:
    """Columns of ``asked`` plus (word, kind, name) for every known word in its text.

    The term table has one row per written definition, so it is broadcast; the texts stay where they are.
    """
    terms = model.terms(asked.sparkSession)
    longest = max(len(w.split()) for t in (*model.measures, *model.filters, *model.dimensions) for w in (t.name, *t.synonyms))
    words = asked.withColumn("word", F.explode(F.array_distinct(phrases(F.col(text), longest))))
    return words.join(F.broadcast(terms), "word")


def smoke_report(spark: SparkSession, model: SemanticModel, tables: Mapping[str, DataFrame]) -> DataFrame:
    """question, state (passed / empty / error), message for each stored question with its default parameters.

    One row per question decides the state; no result is counted in full. A table that several questions ask is computed once and stored.
    """
    sources = [question.source for question in model.questions]
    tables = stored_once(tables, {name for name in sources if sources.count(name) > 1})
    rows = []
    for question in model.questions:
        try:
            found = model.answer(spark, question.name, tables).limit(1).count()
            rows.append((question.name, "passed" if found else "empty", None))
        except Exception as error:  # the report is about whatever goes wrong
            rows.append((question.name, "error", str(error).splitlines()[0]))
    return spark.createDataFrame(rows, "question string, state string, message string")
