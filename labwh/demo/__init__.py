"""The operators and reports on the generated TPC-H-like tables, each with a SQL oracle."""

from importlib import import_module

from labwh.demo.registry import ORACLES, QUERIES

MODULES = (
    "attendance_queries",
    "ranking_queries",
    "project_queries",
    "company_queries",
    "salary_queries",
    "log_and_sink_queries",
    "store_queries",
    "report_attendance",
    "report_labourers",
    "report_salary",
    "report_projects",
    "report_companies",
    "report_compliance",
    "report_logs",
)


def _load() -> None:
    for name in MODULES:
        import_module(f"labwh.demo.{name}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
