"""Tool calls in chat responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CALLS = "array<struct<function:struct<name:string,arguments:string>>>"
MESSAGE = f"struct<role:string,content:string,tool_calls:{CALLS}>"
RESPONSE = f"message {MESSAGE}, choices array<struct<message:{MESSAGE}>>"


def tool_calls(response: Column) -> Column:
    """Calls of a response as array<struct<name, arguments, is_raw>>.

    Both shapes are read: a top-level message, else the first choice.
    Arguments that are no JSON become ``{"raw": ...}``."""
    parsed = F.from_json(response, RESPONSE)
    direct = parsed["message"]["tool_calls"]
    chosen = F.get(parsed["choices"], F.lit(0))["message"]["tool_calls"]
    calls = F.when(F.coalesce(F.size(direct), F.lit(0)) > 0, direct).otherwise(
        F.coalesce(chosen, F.array().cast(CALLS))
    )

    def one(call: Column) -> Column:
        name = F.coalesce(call["function"]["name"], F.lit(""))
        text = F.coalesce(call["function"]["arguments"], F.lit("{}"))
        is_raw = F.try_parse_json(text).isNull()
        arguments = F.when(is_raw, F.to_json(F.struct(text.alias("raw")))).otherwise(text)
        return F.struct(name.alias("name"), arguments.alias("arguments"), is_raw.alias("is_raw"))

    return F.transform(calls, one)
