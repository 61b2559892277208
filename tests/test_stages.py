from __future__ import annotations

import dataclasses
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from replygauge.functions import lexicon as lx
from replygauge.operators import prompting as pr
from replygauge.operators import stages as st

TICKETS = [
    ("1", "Order SNX-4421 for a dishwasher. Delivered wrong model. Want replacement."),
    ("2", "not working. please help."),
    ("3", 'He said "hello"\nand my refund not received'),
    ("4", "  "),
    ("5", None),
]


@pytest.fixture
def tickets(spark):
    return spark.createDataFrame(TICKETS, "support_ticket_id string, support_ticket_desc string")


@pytest.fixture
def prompts(spark):
    return spark.createDataFrame(
        [(s.name, f"You are {s.name}.", "v1") for s in st.STAGES], "stage string, text string, version string"
    )


def test_rules_score_every_row_and_keep_blanks_as_errors(tickets):
    enriched = st.enrich(tickets)
    rows = {r.support_ticket_id: r for r in enriched.collect()}
    assert len(rows) == len(TICKETS)
    summary = rows["1"].summarise.summary
    assert summary.startswith("The ticket is about wrong item and asks for replacement") and summary.endswith("It states SNX-4421.")
    assert "Delivered wrong model" in summary
    # The second ticket names nothing that an agent needs, so nothing of it is missing.
    assert rows["2"].judge_summary.field_coverage_score == 3 and rows["2"].judge_response.overall_score < 6
    assert rows["1"].judge_summary.field_coverage_score == 3
    # The reply answers with one clause, which names no time: 3 and 2.
    judged = rows["1"].judge_response
    assert (judged.issue_addressal_score, judged.resolution_clarity_score, judged.overall_score) == (3, 2, 5)
    for name in ("4", "5"):
        assert rows[name].summarise_class == "empty"
        assert rows[name].summarise is None
        assert rows[name].judge_response_class == "empty"


def test_all_stages_are_one_narrow_pass(tickets):
    plan = st.consolidate(st.enrich(tickets))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan
    assert "Exchange Single" not in plan
    assert "Python" not in plan


def test_consolidated_row_has_the_contractual_columns(tickets):
    flat = st.consolidate(st.enrich(tickets.withColumn("other", F.lit(1))))
    assert flat.columns == lx.CONSOLIDATED_COLUMNS
    assert dict(flat.dtypes)["overall_score"] == "int"


def test_stage_counts(tickets):
    counts = {r.stage: r.n for r in st.stage_counts(st.enrich(tickets)).collect()}
    assert counts == {"summarise": 3, "judge_summary": 3, "respond": 3, "judge_response": 3, "total": 12}


def test_stage_settings(spark):
    settings = {r.stage: (r.temperature, r.max_tokens) for r in st.stage_table(spark).collect()}
    assert settings == {
        "summarise": (0.2, 400), "judge_summary": (0.0, 500), "respond": (0.4, 1500), "judge_response": (0.0, 1200),
    }


def test_reply_stage_reads_the_summary_only():
    assert st.RESPOND.inputs == ["summary"]
    assert st.JUDGE_SUMMARY.inputs == ["ticket", "summary"]


def test_prompt_and_messages(spark):
    df = spark.createDataFrame([("a \n\n",)], "t string")
    prompt = pr.close_prompt(pr.render(("<", pr.Ref("x"), ">\n\n"), {"x": "t"}), "END")
    assert df.select(prompt).first()[0] == "<a \n\n>\nEND"
    messages = pr.assemble_messages(F.lit("s"), "t")
    row = df.select(
        pr.last_message(messages, "user"), pr.last_message(messages, "tool"),
        pr.last_message(F.concat(messages, pr.assemble_messages(F.lit("s2"), F.lit("u2"))), "system"),
    ).first()
    assert tuple(row) == ("a \n\n", "", "s2")


def test_last_messages_of_a_table(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 2, "user", "b"), (1, 1, "assistant", "c"), (2, 0, "assistant", "d")],
        "conv_id int, turn int, role string, text string",
    )
    assert {tuple(r) for r in pr.last_messages(df, "user").collect()} == {(1, "b"), (2, "")}


def logging_model(log, refuse="please help", reply=None, lose=None):
    """Appends each prompt it answers to a file; raises on one text, leaves out another."""

    def make(settings):
        with open(f"{log}.made", "a") as file:
            file.write(f"{settings.stage} {settings.model} {settings.temperature} {settings.max_tokens}\n")

        def score(batch):
            texts = [m[-1]["content"] for m in batch["messages"]]
            if any(refuse in t for t in texts):
                raise ValueError("no")
            with open(log, "a") as file:
                file.writelines("x\n" for _ in texts)
            raws = [reply or json.dumps({"output": {"summary": t.splitlines()[0]}}) for t in texts]
            out = batch[["request_key"]].assign(raw=raws)
            return out[[not lose or lose not in t for t in texts]]

        return score

    return make


def asked(log):
    return len(log.read_text().splitlines()) if log.exists() else 0


def run(tickets, log, store, prompts, model="m", stage=st.SUMMARISE, **faults):
    result = st.run_model(tickets, stage, st.FIELDS, logging_model(str(log), **faults), store, prompts, model)
    return {r.support_ticket_id: r for r in result.collect()}


def test_model_stage_isolates_errors_collapses_copies_and_resumes(spark, tickets, prompts, tmp_path):
    log, store = tmp_path / "log", st.ReplyStore(str(tmp_path / "replies"))
    copies = tickets.unionByName(tickets.where("support_ticket_id = '1'").withColumn("support_ticket_id", F.lit("6")))
    rows = run(copies, log, store, prompts)
    assert set(rows) == {"1", "2", "3", "4", "5", "6"}
    assert rows["2"].summarise_error == "ValueError: no" and rows["2"].summarise_class == "empty"
    assert rows["1"].summarise_class == "ok"
    assert rows["1"].summarise.summary == rows["6"].summarise.summary == f'Ticket: "{TICKETS[0][1]}"'
    assert asked(log) == 2, "copies are asked once, blank texts not at all"
    assert {rows[i].summarise_class for i in ("4", "5")} == {"empty"}
    made = (tmp_path / "log.made").read_text().splitlines()
    assert len(made) <= 8 and set(made) == {"summarise m 0.2 400"}, "once per partition, with the settings"

    run(copies, log, store, prompts)
    assert asked(log) == 2, "stored replies are not asked for again"
    rows = run(copies, log, store, prompts, refuse="nothing")
    assert asked(log) == 3, "only the failed one is asked again"
    assert rows["2"].summarise_class == "ok" and rows["2"].summarise_error is None
    run(copies, log, store, prompts, refuse="nothing", model="other")
    assert asked(log) == 6, "another model has other keys"


def test_a_bad_reply_is_asked_again_up_to_the_given_attempts(tickets, prompts, tmp_path):
    log, store = tmp_path / "log", st.ReplyStore(str(tmp_path / "replies"), attempts=2)
    one = tickets.where("support_ticket_id = '1'")
    for n in (1, 2, 2):
        rows = run(one, log, store, prompts, reply='{"output": {"summary": "cut')
        assert rows["1"].summarise_class == "truncated" and asked(log) == n
    longer = dataclasses.replace(st.SUMMARISE, max_tokens=800)
    assert run(one, log, store, prompts, stage=longer)["1"].summarise_class == "ok", "another token limit is another key"
    more = st.ReplyStore(store.path, attempts=3)
    assert run(one, log, more, prompts)["1"].summarise_class == "ok", "a good reply replaces the bad ones"
    assert run(one, log, store, prompts)["1"].summarise_class == "ok"


def test_lost_rows_are_errors(tickets, prompts, tmp_path):
    rows = run(tickets, tmp_path / "log", st.ReplyStore(str(tmp_path / "r")), prompts, lose="SNX")
    assert rows["1"].summarise_error == "no reply" and rows["1"].summarise_class == "empty"
    assert rows["3"].summarise_class == "ok"


@pytest.mark.parametrize("answer", [
    lambda b: b[["request_key"]].assign(raw="x", request_key="unknown"),
    lambda b: pd.concat([b, b])[["request_key"]].assign(raw="x"),
])
def test_unknown_and_repeated_keys_are_errors(answer):
    batch = pd.DataFrame({"request_key": ["a", "b"], "messages": [[], []]})
    out = pd.concat(st.isolated(lambda settings: answer, None)(iter([batch])))
    assert out["request_key"].tolist() == ["a", "b"] and out["error"].str.contains("unknown or repeated").all()


def test_model_result_used_twice_asks_once(spark, tickets, prompts, tmp_path):
    log = tmp_path / "log"
    result = st.run_model(tickets, st.SUMMARISE, st.FIELDS, logging_model(str(log)), st.ReplyStore(str(tmp_path / "r")), prompts, "m")
    n = asked(log)
    result.count()
    result.select("summarise").collect()
    assert asked(log) == n


def test_unknown_prompt_is_an_error(tickets, prompts, tmp_path):
    with pytest.raises(ValueError, match="expected one prompt"):
        run(tickets, tmp_path / "log", st.ReplyStore(str(tmp_path)), prompts.where("false"))


def test_texts_stay_out_of_the_joins_between_model_stages(spark, tickets, prompts, tmp_path):
    def model(settings):
        schema = next(s.schema for s in st.STAGES if s.name == settings.stage)
        values = {f.name: 2 if f.name.endswith("score") else "told" for f in schema.fields}
        return lambda batch: batch[["request_key"]].assign(raw=json.dumps({"output": values}))

    twice = tickets.union(tickets).union(tickets.where("support_ticket_id = '3'"))
    store = st.ReplyStore(str(tmp_path / "replies"))
    result = st.enrich_with_model(twice, model, store, prompts, "m")
    stages = [c for s in st.STAGES for c in (f"{s.name}_raw", f"{s.name}_error", f"{s.name}_class", s.name)]
    assert result.columns == ["support_ticket_id", "support_ticket_desc", *stages]
    rows = [(r.support_ticket_id, r.judge_summary_class, r.judge_response_class) for r in result.collect()]
    assert sorted(rows) == sorted([(i, "ok", "ok") for i in "1231233"] + [(i, "empty", "empty") for i in "4545"])
    assert spark.read.parquet(store.path).groupBy("stage").count().where("count > 3").count() == 0
    plan = result.select("support_ticket_id", "judge_response_class")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1
