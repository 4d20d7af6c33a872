"""Chat messages for each prompting regime, and ChatML text.

Shared assets (system text, ontology description, template, example) are
constants of the plan: Catalyst folds them into the projection, so nothing
is joined or shuffled to attach them (J2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom import prompt_texts as P

REGIMES = ("zero_shot", "zero_shot_template", "one_shot", "fine_tuned")

MESSAGE_TYPE = "array<struct<role:string,content:string>>"


def system_text(regime: str, ontology: str | None = None, template: str | None = None) -> str:
    """The system message of a regime, assets spliced in."""
    onto = P.ONTOLOGY_DESCRIPTION if ontology is None else ontology
    if regime == "zero_shot":
        return P.ZERO_SHOT_SYSTEM.replace("{ontology}", onto)
    if regime == "zero_shot_template":
        tpl = P.GRAPH_TEMPLATE if template is None else template
        return P.ZERO_SHOT_TEMPLATE_SYSTEM.replace("{ontology}", onto).replace("{template}", tpl)
    if regime == "one_shot":
        return P.ONE_SHOT_SYSTEM.replace("{ontology}", onto)
    if regime == "fine_tuned":
        return P.FINE_TUNED_SYSTEM
    raise ValueError(f"unknown regime {regime}")


def translate_text(example: str | None = None) -> str:
    return P.TRANSLATE_SYSTEM.replace("{example}", P.EXAMPLE_GRAPH if example is None else example)


def messages(system: str | Column, user: str | Column) -> Column:
    s = F.lit(system) if isinstance(system, str) else system
    u = F.col(user) if isinstance(user, str) else user
    return F.array(F.struct(F.lit("system").alias("role"), s.alias("content")),
                   F.struct(F.lit("user").alias("role"), u.alias("content")))


def build_prompts(df: DataFrame, regime: str, text_col: str = "text", ontology: str | None = None,
                  template: str | None = None) -> DataFrame:
    """Add ``regime`` and ``messages`` (system, user=text).

    For ``one_shot`` pass chunk rows (``chunk_text``) and ``text_col='chunk'``.
    """
    return df.withColumn("regime", F.lit(regime)).withColumn(
        "messages", messages(system_text(regime, ontology, template), text_col))


def build_translate_prompts(df: DataFrame, text_col: str = "individuals", example: str | None = None) -> DataFrame:
    """Second one-shot pass: translate the assembled first-pass answers."""
    return df.withColumn("messages", messages(translate_text(example), text_col))


def render_chat(msgs: str | Column = "messages", add_generation_prompt: bool = False) -> Column:
    """ChatML text of a message list; optionally open the assistant turn."""
    m = F.col(msgs) if isinstance(msgs, str) else msgs
    body = F.array_join(F.transform(m, lambda x: F.concat(
        F.lit(P.CHATML_START), x["role"], F.lit("\n"), x["content"], F.lit(P.CHATML_END + "\n"))), "")
    if add_generation_prompt:
        body = F.concat(body, F.lit(P.CHATML_START + "assistant\n"))
    return body


def expand_models(docs: DataFrame, models: list[str] | Column, partitions: int | None = None) -> DataFrame:
    """Every document x every model of the sweep.

    The model list is configuration (a handful of names), so each document row
    is exploded over it in place: no join and no shuffle.  ``partitions``
    spreads the (doc, model) rows before the model calls so that a few large
    documents do not serialise the calls in one task.  Models given as a column are
    each document's own.
    """
    out = docs.withColumn("model", F.explode(models if isinstance(models, Column) else F.array(*[F.lit(m) for m in models])))
    if partitions:
        out = out.repartition(partitions, "doc_id", "model")
    return out
