"""Reports on logged API calls, on the derived log tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from labwh.demo.registry import query
from labwh.demo.roles import Roles, with_roles
from labwh.demo.tables import Tables
from labwh.plans import apilogs as plan


@query(oracle=with_roles("""
    SELECT json_extract_string(data, '$[0].real_name') AS real_name,
      json_extract_string(data, '$[0].id_card_no') AS id_card_no,
      coalesce(json_extract_string(data, '$[0].proj.pid'), json_extract_string(data, '$[0].source_project.pid'))
        AS pid,
      'P' || CAST(event_id % 90 AS VARCHAR) AS project_name, CAST(NULL AS VARCHAR) AS response_code, create_time
    FROM api_log WHERE method = 'labourer.import' AND appid = 1001
"""))
def report_api_calls(t: Tables) -> DataFrame:
    return plan.api_calls(Roles(t).api_log)


@query(oracle=with_roles("""
    SELECT json_extract_string(data, '$[0].id_card_no') AS id, count(*) AS count, 1 AS type
    FROM api_log WHERE method = 'labourer.import' AND appid = 1001 GROUP BY 1
    UNION ALL
    SELECT json_extract_string(data, '$[0].proj.pid'), count(*), 2
    FROM api_log WHERE method = 'labourer.import' AND appid = 1001 GROUP BY 1
"""))
def report_api_call_counts(t: Tables) -> DataFrame:
    return plan.api_call_counts(Roles(t).api_log)


@query(oracle=with_roles("""
    SELECT substr(replace(data, chr(92), ''), 2) AS datas,
      json_extract_string(replace(data, chr(92), ''), '$[0].real_name') AS real_name,
      json_extract_string(replace(data, chr(92), ''), '$[0].mobilephone') AS mobilephone,
      CAST(NULL AS VARCHAR) AS project_name, message, request_time
    FROM audit_log
"""))
def report_rejected_calls(t: Tables) -> DataFrame:
    return plan.rejected_calls(Roles(t).audit_log)


@query(oracle=with_roles("""
    SELECT DISTINCT json_extract_string(request_content, '$.dto.method') AS method,
      json_extract_string(request_content, '$.dto.appid') AS appid,
      json_extract_string(request_content, '$.dto.data') AS data,
      json_extract_string(response_content, '$.code') AS code,
      json_extract_string(response_content, '$.message') AS message
    FROM request_log
    WHERE api = '/openapi' AND json_extract_string(response_content, '$.code') <> '0'
      AND json_extract_string(request_content, '$.dto.method') = 'labourer.import'
"""))
def report_failed_requests(t: Tables) -> DataFrame:
    log = Roles(t).request_log
    older = log.where("request_content LIKE '%1\"}}'")
    return plan.failed_requests([log, older])
