"""Inference stages: prompt, scorer, strict parser.

A stage sends one prompt per row to a scorer and parses the reply. There are two
kinds of scorer. A rule scorer is a column expression, so all stages together
are one narrow pass over the input. A model scorer is Python code over pandas
batches; its replies are stored under a key of everything that went into them, so
a good reply is never asked for twice, and a bad one is asked for again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.functions import text as tx
from replygauge.functions.replies import OK, ReplySchema, Score, Text, parse_replies
from replygauge.functions.text import ColumnOrName, as_column
from replygauge.operators.joins import join_repeated
from replygauge.operators.prompting import Ref, assemble_messages, close_prompt, render
from replygauge.session import work_folder
from replygauge.sources.tickets import read_if_present


@dataclass(frozen=True)
class Stage:
    """Settings of one stage."""

    name: str
    template: tuple[str | Ref, ...]
    temperature: float
    max_tokens: int
    schema: ReplySchema

    @property
    def inputs(self) -> list[str]:
        return [part.field for part in self.template if isinstance(part, Ref)]


# Templates, temperatures, token limits and reply fields of the stages.
SUMMARISE = Stage(
    "summarise", ('Ticket: "', Ref("ticket"), '"\nSummary:'), 0.2, 400,
    ReplySchema((Text("summary"),)),
)
JUDGE_SUMMARY = Stage(
    "judge_summary", 
    ('Original Ticket: "', Ref("ticket"), '"\nTicket Summary: "', Ref("summary"), '"\nEvaluate the summary.'),
    0.0, 500,
    ReplySchema((
        Score("information_extraction_score"), Text("information_extraction_reasoning"),
        Score("field_coverage_score"), Text("field_coverage_reasoning"),
    )),
)
RESPOND = Stage(
    "respond", ('Ticket Summary: "', Ref("summary"), '"'), 0.4, 1500,
    ReplySchema((Text("response"),)),
)
JUDGE_RESPONSE = Stage(
    "judge_response", 
    ('Ticket Summary: "', Ref("summary"), '"\nGenerated Response: "', Ref("response"), '"\nEvaluate the response.'),
    0.0, 1200,
    ReplySchema((
        Score("issue_addressal_score"), Text("issue_addressal_reasoning"),
        Score("resolution_clarity_score"), Text("resolution_clarity_reasoning"),
        Score("overall_score", 2, 6), Text("overall_reasoning"),
    )),
)
STAGES = [SUMMARISE, JUDGE_SUMMARY, RESPOND, JUDGE_RESPONSE]


def stage_table(spark: SparkSession) -> DataFrame:
    """The stage settings as rows, for audit next to the results."""
    return spark.createDataFrame(
        [(s.name, s.temperature, s.max_tokens, s.schema.ddl) for s in STAGES],
        "stage string, temperature double, max_tokens int, reply_fields string",
    )


@dataclass(frozen=True)
class RuleScorer:
    """A scorer made of column expressions.

    ``features`` adds what it needs to know about one input of a stage to the table,
    as columns named ``__<input>_*``: (table, input, column) -> table. They are computed
    once for all stages that read the same text. ``reply`` makes a stage's JSON reply
    from them.
    """

    features: Callable[[DataFrame, str, str], DataFrame]
    reply: Callable[[Stage], Column]


def run_rules(df: DataFrame, stage: Stage, fields: Mapping[str, str], scorer: RuleScorer) -> DataFrame:
    """Run a stage with a rule scorer. Adds raw reply, class and parsed struct.

    A row with a blank input is not sent; its class is ``empty``. Feature columns
    stay on the row, named ``__<input>_<feature>``, for the stages that follow.
    """
    for name in stage.inputs:
        if not any(column.startswith(f"__{name}_") for column in df.columns):
            df = scorer.features(df, name, fields[name])
    unsent = reduce(or_, [tx.is_blank(fields[name]) for name in stage.inputs])
    raw = f"{stage.name}_raw"
    scored = df.withColumn(raw, F.when(~unsent, scorer.reply(stage)))
    return parse_replies(scored, raw, stage.schema, into=stage.name)


# Where each stage finds its inputs on the row.
FIELDS = {"ticket": "support_ticket_desc", "summary": "summarise.summary", "response": "respond.response"}


def enrich(tickets: DataFrame, scorer: RuleScorer | None = None) -> DataFrame:
    """All four stages over a ticket table, without a shuffle of the tickets.

    Without a scorer, the baseline that is fitted to these tickets: one pass before
    this one, which counts words.
    """
    if scorer is None:
        from replygauge.operators import baseline

        scorer = baseline.fit(tickets)
    enriched = tickets
    for stage in STAGES:
        enriched = run_rules(enriched, stage, FIELDS, scorer)
    return enriched.drop(*[name for name in enriched.columns if name.startswith("__")])


def output_columns() -> dict[str, str]:
    """Where each column of the flat row stands on the enriched row, in order."""
    renamed = {"summarisation": "summarise.summary", "response_generation": "respond.response"}
    owner = {name: stage.name for stage in STAGES for name in stage.schema.names}
    return {name: renamed.get(name) or (f"{owner[name]}.{name}" if name in owner else name) for name in lx.CONSOLIDATED_COLUMNS}


def consolidate(enriched: DataFrame) -> DataFrame:
    """The flat output row: contractual names and order, nothing else."""
    return enriched.select(*[F.col(place).alias(name) for name, place in output_columns().items()])


def stage_counts(enriched: DataFrame) -> DataFrame:
    """Usable replies per stage and in total."""
    counted = enriched.agg(*[F.count_if(F.col(f"{s.name}_class") == OK).alias(s.name) for s in STAGES])
    rows = F.array(*[F.struct(F.lit(s.name).alias("stage"), F.col(s.name).alias("n")) for s in STAGES])
    per_stage = counted.select(F.inline(rows))
    return per_stage.rollup("stage").agg(F.sum("n").alias("n")).withColumn(
        "stage", F.coalesce("stage", F.lit("total"))
    )


# -- model scorers ----------------------------------------------------------


@dataclass(frozen=True)
class ModelSettings:
    """What a scorer is told besides the messages."""

    stage: str
    model: str
    temperature: float
    max_tokens: int


# Takes a batch with request_key and messages; returns request_key, raw and, if it likes, error.
BatchScorer = Callable[[pd.DataFrame], pd.DataFrame]
# Called once per partition, so that a client or a model is built once.
ScorerFactory = Callable[[ModelSettings], BatchScorer]


def system_text(prompts: DataFrame, stage: Stage) -> tuple[str, str]:
    """Instruction text of a stage and its version."""
    found = prompts.where(F.col("stage") == stage.name).take(2)
    if len(found) != 1:
        raise ValueError(f"expected one prompt for the stage {stage.name}, found {len(found) or 'none'}")
    return found[0]["text"], found[0]["version"]


def request_key(stage: Stage, version: str, model: str, user_text: ColumnOrName) -> Column:
    """Key of a reply: everything that went into asking for it, the token limit and the reply's fields included."""
    settings = [stage.name, model, str(stage.temperature), str(stage.max_tokens), stage.schema.ddl, version]
    return F.sha2(F.concat_ws("\x1f", *map(F.lit, settings), as_column(user_text)), 256)


def isolated(
    make_scorer: ScorerFactory, settings: ModelSettings
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """One reply or error for each request, whatever the scorer does.

    A batch that raises, or answers for keys it was not given or twice for one, is
    halved and tried again; a row that still fails gets the error's text. A row the
    scorer leaves out gets the error ``no reply``.
    """

    def replies(score: BatchScorer, part: pd.DataFrame) -> pd.DataFrame:
        got = score(part)
        if not got["request_key"].is_unique or not got["request_key"].isin(part["request_key"]).all():
            raise ValueError("replies with unknown or repeated keys")
        if "error" not in got:
            got = got.assign(error=None)
        out = part[["request_key"]].merge(got[["request_key", "raw", "error"]], on="request_key", how="left")
        lost = ~out["request_key"].isin(got["request_key"])
        return out.assign(error=out["error"].astype(object).mask(lost, "no reply"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = None
        for batch in batches:
            score = score or make_scorer(settings)
            waiting = [batch]
            while waiting:
                part = waiting.pop()
                if not len(part):
                    continue
                try:
                    yield replies(score, part)
                except Exception as error:
                    if len(part) == 1:
                        yield part[["request_key"]].assign(raw=None, error=f"{type(error).__name__}: {error}")
                    else:
                        middle = len(part) // 2
                        waiting += [part.iloc[middle:], part.iloc[:middle]]

    return run


_STORE_SCHEMA = "request_key string, raw string, error string, reply_class string, attempt int, stage string, model string, version string"


@dataclass(frozen=True)
class ReplyStore:
    """Stored replies, one Parquet table partitioned by stage, model and prompt version.

    Every attempt is a row with the class its reply was given. A reply that is not
    ``ok`` is asked for again by later runs, up to ``attempts`` times.
    """

    path: str
    attempts: int = 3

    def read(self, spark: SparkSession, stage: Stage, model: str, version: str) -> DataFrame:
        stored = read_if_present(spark, self.path, _STORE_SCHEMA)
        return stored.where((F.col("stage") == stage.name) & (F.col("model") == model) & (F.col("version") == version))

    def best(self, keys: DataFrame, stage: Stage, model: str, version: str) -> DataFrame:
        """The best attempt of each of the given keys: a good reply, else the last. Only their rows are grouped."""
        mine = self.read(keys.sparkSession, stage, model, version).join(keys.select("request_key"), "request_key", "left_semi")
        rank = F.struct(F.col("reply_class") == OK, "attempt")
        return mine.groupBy("request_key").agg(
            F.max_by(F.struct("raw", "error", "reply_class"), rank).alias("x"), F.max("attempt").alias("attempt")
        ).select("request_key", "x.raw", "x.error", "x.reply_class", "attempt")

    def ask(
        self, asked: DataFrame, stage: Stage, system: str, version: str, model: str, make_scorer: ScorerFactory,
        requests_per_task: int = 500, copies: bool = True,
    ) -> DataFrame:
        """The best reply of each distinct request, asking only where it is missing or bad.

        ``asked`` holds ``request_key`` and ``user_text``, null for what is not to be
        sent; it is read twice, for its keys and for the texts to send. Work tables hold
        keys alone. Copies collapse before the shuffle, unless ``copies`` says that there
        are hardly any: then once they have met. The instruction text is added only
        after it. The number of tasks follows the number of requests. Returns a table
        (request_key, raw, error) of this run, read from the work folder.
        """
        spark = asked.sparkSession
        sent = asked.where(F.col("user_text").isNotNull())
        distinct = _kept(sent.select("request_key").distinct(), "requests")
        stored = self.best(distinct, stage, model, version).select("request_key", "reply_class", "attempt")
        open_ = F.col("attempt").isNull() | ((F.col("reply_class") != OK) & (F.col("attempt") < self.attempts))
        todo = _kept(distinct.join(stored, "request_key", "left").where(open_).select("request_key", "attempt"), "todo")
        tasks = max(1, -(-todo.count() // requests_per_task))
        texts, open_keys = sent.select("request_key", "user_text"), todo.select("request_key")
        if copies:
            collapsed = texts.groupBy("request_key").agg(F.first("user_text").alias("user_text"))
            dealt = collapsed.join(open_keys, "request_key", "left_semi").repartition(tasks, "request_key")
        else:
            # both sides are dealt out alike, so that neither is shuffled again to be joined
            met = texts.repartition(tasks, "request_key").join(open_keys.repartition(tasks, "request_key"), "request_key", "left_semi")
            dealt = met.dropDuplicates(["request_key"])
        answered = dealt.select(
            "request_key", assemble_messages(F.lit(system), "user_text").alias("messages")
        ).mapInPandas(
            isolated(make_scorer, ModelSettings(stage.name, model, stage.temperature, stage.max_tokens)),
            "request_key string, raw string, error string",
        )
        classed = parse_replies(answered, "raw", stage.schema, into="reply").select("request_key", "raw", "error", "reply_class")
        numbered = classed.join(todo.select("request_key", (F.coalesce("attempt", F.lit(0)) + 1).alias("attempt")), "request_key")
        numbered.withColumns({"stage": F.lit(stage.name), "model": F.lit(model), "version": F.lit(version)}).write.mode(
            "append"
        ).partitionBy("stage", "model", "version").parquet(self.path)
        best = self.best(distinct, stage, model, version)
        error = F.when(F.col("raw").isNull(), F.col("error"))
        return _kept(best.select("request_key", "raw", error.alias("error")), "replies")


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    """A table of this run in the shared work folder."""
    path = work_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_model(
    df: DataFrame,
    stage: Stage,
    fields: Mapping[str, str],
    make_scorer: ScorerFactory,
    store: ReplyStore,
    prompts: DataFrame,
    model: str,
    requests_per_task: int = 500,
    copies: bool = True,
) -> DataFrame:
    """Run a stage with a model scorer. Adds raw reply, error, class and parsed struct.

    A row with a blank input is not sent; its class is ``empty``, as with rules.
    Only request keys and messages cross into Python. Replies come from a stored
    table, so using the result twice does not ask twice. ``copies``: may prompts repeat
    often? Results do not depend on it.
    """
    raw, error = f"{stage.name}_raw", f"{stage.name}_error"
    system, version = system_text(prompts, stage)
    unsent = reduce(or_, [tx.is_blank(fields[name]) for name in stage.inputs])
    user = F.when(~unsent, close_prompt(render(stage.template, {name: fields[name] for name in stage.inputs})))
    key = F.when(user.isNotNull(), request_key(stage, version, model, user))
    asked = df.withColumn("request_key", key)
    replies = store.ask(
        asked.select("request_key", user.alias("user_text")), stage, system, version, model, make_scorer, requests_per_task, copies
    )
    named = replies.withColumnsRenamed({"raw": raw, "error": error})
    joined = join_repeated(asked, named, "request_key").drop("request_key")
    return parse_replies(joined, raw, stage.schema, into=stage.name)


def enrich_with_model(
    tickets: DataFrame, make_scorer: ScorerFactory, store: ReplyStore, prompts: DataFrame, model: str, requests_per_task: int = 500
) -> DataFrame:
    """All four stages with a model. A row that fails in one stage is not sent to those that need its result.

    The stages see nothing of a row but its text, so they run once for each distinct
    text. What they made of it is a table with the text's key instead of the text, which
    only goes through a shuffle where a prompt holds it; rows get their results by that key.
    """
    text, key = FIELDS["ticket"], "__text_key"
    keyed = tickets.withColumn(key, F.coalesce(F.unhex(F.sha2(F.col(text), 256)), F.lit(b"")))
    told: DataFrame | None = None
    for stage in STAGES:
        first = told is None
        if first:
            rows = keyed.select(key, text)
        elif "ticket" in stage.inputs:
            texts = keyed.groupBy(key).agg(F.first(text).alias(text))
            rows = _kept(texts.join(told, key), "told-of-texts")
        else:
            rows = told
        copies = "ticket" not in stage.inputs or first
        result = run_model(rows, stage, FIELDS, make_scorer, store, prompts, model, requests_per_task, copies).drop(text)
        told = _kept(result.dropDuplicates([key]) if first else result, "told")
    return join_repeated(keyed, told, key).drop(key)
