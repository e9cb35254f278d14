"""The columns each endpoint documents: spec documents to a long vocabulary table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from response_ledger.functions.text import (
    HEADINGS,
    heading_positions,
    inline_elements,
    list_after,
    sentence_columns,
    split_columns,
)
from response_ledger.schemas import ENDPOINTS, endpoint_rows


def endpoint_descriptions(specs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """
    One row per spec document (`text`) and catalogue endpoint, with its description; NULL
    where the spec does not have the endpoint.
    """
    paths = F.from_json("text", "struct<paths:map<string,map<string,string>>>")["paths"]
    operation = F.try_element_at(F.try_element_at("paths", F.col("path")), F.lower("method"))
    return (
        specs.select(*keep, paths.alias("paths"))
        .select(*keep, "paths", F.inline(endpoint_rows()))
        .select(
            *keep,
            "request_type",
            "method",
            "path",
            F.get_json_object(operation, "$.description").alias("description"),
        )
    )


def heading_columns(described: DataFrame, headings: dict[str, str] = HEADINGS) -> DataFrame:
    """
    `described` with `lists`, one (role, columns, error) per heading: the names in the first
    `<i>` behind the only `<b>` with that text, or why there are none.
    """
    read = described.withColumn("_elements", inline_elements(F.col("description")))
    for role, heading in headings.items():
        read = read.withColumn(f"_{role}_at", heading_positions(F.col("_elements"), heading))
    for role in headings:
        alone = F.when(F.size(f"_{role}_at") == 1, F.get(f"_{role}_at", F.lit(0)))
        read = read.withColumn(f"_{role}_list", list_after(F.col("_elements"), alone))
    entries = []
    for role, heading in headings.items():
        found, text = F.size(f"_{role}_at"), F.col(f"_{role}_list")
        error = F.when(
            found != 1,
            F.format_string(f"heading '{heading}' occurs %s times, not once", found),
        ).when(text.isNull(), F.lit(f"no list behind heading '{heading}'"))
        entries.append(
            F.struct(
                F.lit(role).alias("role"), split_columns(text).alias("columns"), error.alias("error")
            )
        )
    return read.withColumn("lists", F.array(*entries)).drop(
        "_elements", *[f"_{role}_{part}" for role in headings for part in ("at", "list")]
    )


def documented_lists(specs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per spec, endpoint and role: the column list, or the error that kept it from being read."""
    described = endpoint_descriptions(specs, keep)
    named = (*keep, "request_type", "method", "path")
    paged = F.col("method") == "POST"
    missing = F.array(
        F.struct(
            F.lit("display").alias("role"),
            F.lit(None).cast("array<string>").alias("columns"),
            F.lit("endpoint is not in the spec").alias("error"),
        )
    )
    # Only a paged endpoint's description is markup; the others skip the element scan.
    markup = described.withColumn(
        "sentence", F.when(~paged, F.col("description"))
    ).withColumn("description", F.when(paged, F.col("description")))
    read = heading_columns(markup)
    lists = (
        F.when(F.col("description").isNotNull(), F.col("lists"))
        .when(F.col("sentence").isNotNull(), F.col("sentence_lists"))
        .otherwise(missing)
    )
    sentence = F.array(
        F.struct(
            F.lit("display").alias("role"),
            sentence_columns(F.col("sentence")).alias("columns"),
            F.lit(None).cast("string").alias("error"),
        )
    )
    return read.withColumn("sentence_lists", sentence).select(*named, F.inline(lists))


def vocabulary(specs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Long form: one row per documented column, `ordinal` from 1 in documented order."""
    return (
        documented_lists(specs, keep)
        .where(F.col("error").isNull())
        .select(*keep, "request_type", "method", "path", "role", F.posexplode("columns").alias("pos", "column"))
        .withColumn("ordinal", F.col("pos") + 1)
        .drop("pos")
    )


def vocabulary_errors(specs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Endpoints whose documentation is not of the known shape, and how."""
    return documented_lists(specs, keep).where(F.col("error").isNotNull()).drop("columns")


def documented_columns(specs: DataFrame, request_type: str, role: str = "display") -> list[str]:
    """One endpoint's names out of one spec; a documentation of the wrong shape raises."""
    if request_type not in ENDPOINTS:
        raise ValueError(f"{request_type} is no endpoint of the catalogue")
    # An endpoint has three lists at most.
    found = (
        documented_lists(specs)
        .where(F.col("request_type") == request_type)
        .select("role", "columns", "error")
        .take(4)
    )
    if len({one["role"] for one in found}) != len(found):
        raise ValueError("more than one spec document")
    broken = [one["error"] for one in found if one["error"] is not None]
    if broken:
        raise ValueError(broken[0])
    for one in found:
        if one["role"] == role:
            return list(one["columns"])
    return []
