"""Reports on logged API calls with JSON payloads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwh.operators import counts_by_field, extract_json, parsed, payload, variant_field

# Fixed values.
METHOD, APP = "labourer.import", 1001
API = "/openapi"
SITES = ("proj", "source_project")


def _imports(log: DataFrame, method: str, app: int) -> DataFrame:
    return log.where((F.col("method") == method) & (F.col("appid") == app))


def api_calls(log: DataFrame, method: str = METHOD, app: int = APP) -> DataFrame:
    """Person and project fields of each call; older payloads keep the project elsewhere."""
    fields = {"real_name": ["$.real_name"], "id_card_no": ["$.id_card_no"]}
    for name in ("pid", "project_name", "response_code"):
        fields[name] = [f"$.{site}.{name}" for site in SITES]
    return extract_json(_imports(log, method, app), "data", fields).select(*fields, "create_time")


def api_call_counts(log: DataFrame, method: str = METHOD, app: int = APP) -> DataFrame:
    """Calls per person id (type 1) and per project id (type 2)."""
    fields = {"id_card_no": ["$.id_card_no"], "pid": ["$.proj.pid"]}
    calls = extract_json(_imports(log, method, app), "data", fields)
    return counts_by_field(calls, {"id_card_no": 1, "pid": 2}, "type", "id", "count")


def rejected_calls(audit: DataFrame) -> DataFrame:
    """Failed call with its unescaped payload and the fields read from it."""
    fields = {n: [f"$.{n}"] for n in ("real_name", "mobilephone", "project_name")}
    rows = extract_json(audit, "data", fields, unescape=True)
    return rows.select(payload(F.col("data"), unescape=True).alias("datas"), *fields, "message", "request_time")


def failed_requests(logs: Sequence[DataFrame], method: str = METHOD, app: int = APP) -> DataFrame:
    """Distinct failed import calls over several log tables."""

    def failed(log: DataFrame) -> DataFrame:
        rows = log.where(F.col("api") == API).select(
            parsed(F.col("request_content")).alias("request"), parsed(F.col("response_content")).alias("response")
        )
        fields = {n: variant_field(F.col("request"), [f"$.dto.{n}"]) for n in ("method", "appid", "data")}
        fields.update({n: variant_field(F.col("response"), [f"$.{n}"]) for n in ("code", "message")})
        rows = rows.select(*[c.alias(n) for n, c in fields.items()])
        wanted = (F.col("method") == method) & (F.col("appid").try_cast("long") == app)
        return rows.where(wanted & (F.col("code").try_cast("long") != 0))

    return reduce(lambda a, b: a.union(b), [failed(x) for x in logs]).distinct()
