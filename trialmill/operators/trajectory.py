"""Stored agent responses to ordered steps: message, reasoning, tool calls and observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions.text import strip

_NONE = "array<variant>"


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _list(v: Column, path: str) -> Column:
    return F.coalesce(_get(v, path, _NONE), F.array().cast(_NONE))


def texts(parts: Column, thoughts: bool) -> Column:
    """Text parts joined by line breaks, of the visible message or of the reasoning."""

    def wanted(p: Column) -> Column:
        thought = F.coalesce(_get(p, "$.metadata.adk_thought", "boolean"), F.lit(False))
        text = F.coalesce(_get(p, "$.text"), F.lit(""))
        return (_get(p, "$.kind") == "text") & (text != "") & (thought if thoughts else ~thought)

    return strip(F.array_join(F.transform(F.filter(parts, wanted), lambda p: _get(p, "$.text")), "\n"))


def _data_parts(parts: Column, kind: str) -> Column:
    def wanted(p: Column) -> Column:
        found = F.coalesce(F.nullif(_get(p, "$.metadata.adk_type"), F.lit("")), _get(p, "$.metadata.type"))
        return (_get(p, "$.kind") == "data") & (found == kind)

    return F.filter(parts, lambda p: F.coalesce(wanted(p), F.lit(False)))


def tool_calls(parts: Column) -> Column:
    return F.transform(
        _data_parts(parts, "function_call"),
        lambda p, i: F.struct(
            F.coalesce(F.nullif(_get(p, "$.data.id"), F.lit("")), F.concat(F.lit("call-"), i.cast("string"))).alias("tool_call_id"),
            F.coalesce(_get(p, "$.data.name"), F.lit("")).alias("function_name"),
            F.coalesce(F.to_json(_get(p, "$.data.args", "variant")), F.lit("{}")).alias("arguments"),
        ),
    )


def observations(parts: Column) -> Column:
    def content(p: Column) -> Column:
        response = _get(p, "$.data.response", "variant")
        nested = F.schema_of_variant(response).startswith("OBJECT") | F.schema_of_variant(response).startswith("ARRAY")
        return F.when(response.isNull(), "").when(nested, F.to_json(response)).otherwise(
            F.coalesce(_get(p, "$.data.response"), F.lit(""))
        )

    return F.transform(
        _data_parts(parts, "function_response"),
        lambda p: F.struct(_get(p, "$.data.id").alias("source_call_id"), content(p).alias("content")),
    )


def trajectory_steps(responses: DataFrame, key: list[str]) -> DataFrame:
    """One row per step of every stored response.

    ``responses``: key, doc (VARIANT), instruction. History messages of the user and the agent become
    steps in order; without a history the instruction and the response's parts make two steps. Every
    response is handled in its own row.
    """
    doc = F.col("doc")
    history = F.filter(_list(doc, "$.history"), lambda m: _get(m, "$.role").isin("user", "agent"))
    collected = F.concat(
        F.flatten(F.transform(_list(doc, "$.artifacts"), lambda a: _list(a, "$.parts"))),
        _list(doc, "$.status.message.parts"),
        _list(doc, "$.parts"),
    )
    from_history = F.transform(
        history, lambda m: F.struct(_get(m, "$.role").alias("source"), _list(m, "$.parts").alias("parts"))
    )
    without = F.array(
        F.struct(F.lit("user").alias("source"), F.array().cast(_NONE).alias("parts")),
        F.struct(F.lit("agent").alias("source"), collected.alias("parts")),
    )
    steps = F.when(F.size(_list(doc, "$.history")) > 0, from_history).otherwise(without)
    rows = responses.select(*key, "instruction", F.posexplode(steps).alias("_i", "_step"))
    parts, agent = F.col("_step.parts"), F.col("_step.source") == "agent"
    said = texts(parts, thoughts=False)
    empty_first = ~agent & (F.col("_i") == 0) & (said == "")
    return rows.select(
        *key,
        (F.col("_i") + 1).alias("step_id"),
        F.col("_step.source").alias("source"),
        F.when(empty_first, F.col("instruction")).otherwise(said).alias("message"),
        F.when(agent, F.nullif(texts(parts, thoughts=True), F.lit(""))).alias("reasoning_content"),
        F.when(agent, tool_calls(parts)).alias("tool_calls"),
        F.when(agent, observations(parts)).alias("observations"),
    )


def trajectory_totals(responses: DataFrame, steps: DataFrame, key: list[str]) -> DataFrame:
    """Number of steps and token counts per response."""
    counted = steps.groupBy(*key).agg(F.count(F.lit(1)).alias("total_steps"))
    usage = "$.metadata.adk_usage_metadata"
    return responses.select(
        *key,
        _get(F.col("doc"), f"{usage}.promptTokenCount", "bigint").alias("total_prompt_tokens"),
        _get(F.col("doc"), f"{usage}.candidatesTokenCount", "bigint").alias("total_completion_tokens"),
        _get(F.col("doc"), f"{usage}.cachedContentTokenCount", "bigint").alias("total_cached_tokens"),
    ).join(counted, key, "left").withColumn("total_steps", F.coalesce("total_steps", F.lit(0)))
