"""Details that several reports share, and a run that makes reports from them.

Each detail is a method; it asks for the details it builds on, so the methods are the dependency graph. A detail is
computed once per run date, written to the shared folder, and read from there by every report. Reports that build on
the same detail are made one after the other, and the detail is removed behind the last of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession

from labwh.plans import attendance, companies, labourers, projects, salary
from labwh.sources.staging import Run, passing


class Details:
    """``tables`` gives the warehouse tables as attributes; ``city`` is the city of the county reports. With
    ``numbered``, wage lines are stored once with their numbers, which the salary detail shows."""

    def __init__(self, run: Run, tables: object, as_of: dt.date, city: str, numbered: bool = False) -> None:
        self.run, self.tables, self.as_of, self.city, self.numbered = run, tables, as_of, city, numbered

    def _stored(self, name: str, make: Callable[[], DataFrame], dealt: bool = False) -> DataFrame:
        return self.run.detail((name, self.as_of), make, dealt)

    def salary_batches(self) -> DataFrame:
        t = self.tables
        return self._stored("salary_batches", lambda: salary.salary_batches(
            t.batches, t.wages, t.companies, t.bank_accounts, t.projects, t.sub_projects, t.areas))

    def bank_months(self) -> DataFrame:
        return self._stored("bank_months", lambda: salary.bank_area_month(self.salary_batches()))

    def salary_area_months(self) -> DataFrame:
        return self._stored("salary_area_months", lambda: salary.area_months(self.salary_batches()))

    def salary_detail(self) -> DataFrame:
        return self._stored("salary_detail", lambda: salary.salary_detail(*self._line_tables()), dealt=True)

    def salary_lines(self) -> DataFrame:
        if self.numbered:
            return self.salary_detail().drop("batch_top", "salary_top")
        return self._stored("salary_lines", lambda: salary.salary_lines(*self._line_tables()))

    def _line_tables(self) -> tuple[object, ...]:
        t = self.tables
        return (t.batches, t.wages, t.payroll_lines, t.projects, t.sub_projects, t.companies, t.bank_accounts,
                t.areas, self.as_of)

    def metrics(self) -> DataFrame:
        t = self.tables
        return self._stored("metrics", lambda: salary.monthly_metrics(
            t.projects, t.sub_projects, t.deposits, self.salary_lines(), self.as_of))

    def labourer_history(self) -> DataFrame:
        t = self.tables
        return self._stored("labourer_history", lambda: labourers.labourer_history(
            t.labourers, t.employments, t.arrears_amounts, t.areas, self.as_of))

    def resumes(self) -> DataFrame:
        t = self.tables
        return self._stored("resumes", lambda: labourers.resume_detail(
            t.labourers, t.employments, t.projects, t.companies, t.blacklist, t.labourer_banks,
            t.employment_intervals, t.areas, self.as_of))

    def company_project_types(self) -> DataFrame:
        t = self.tables
        return self._stored("company_project_types", lambda: companies.company_project_types(
            t.companies, t.projects, t.sub_projects, t.areas, self.city))

    def project_days(self) -> DataFrame:
        t = self.tables
        return self._stored("project_days", lambda: projects.project_day(
            t.projects, t.areas, t.employments, t.special_accounts, t.deposits, t.billboards, t.devices,
            t.attachments, t.audits, t.agreements, t.batches))

    def build_days(self) -> DataFrame:
        return self._stored("build_days", lambda: projects.build_day(self.project_days()))


    def first(self, name: str) -> str:
        """The detail at the bottom of the one named."""
        below = BASES | ({"salary_lines": "salary_detail"} if self.numbered else {})
        while name in below:
            name = below[name]
        return name

    def drop(self, first: str) -> None:
        """Removes a detail at the bottom and what was built on it."""
        self.run.drop([key for key in self.run.keys() if self.first(key[0]) == first])


#: Details that are built on another one.
BASES = {"bank_months": "salary_batches", "salary_area_months": "salary_batches", "metrics": "salary_lines", "build_days": "project_days"}


@dataclass(frozen=True)
class Report:
    """What is made of a detail, by name; the detail itself if not given."""

    detail: str
    make: Callable[[DataFrame, Details], DataFrame] = lambda rows, _: rows

    def __call__(self, details: Details) -> DataFrame:
        return self.make(getattr(details, self.detail)(), details)


REPORTS: dict[str, Report] = {
    "salary_batches": Report("salary_batches"),
    "bank_area_month": Report("bank_months"),
    "project_bank_rank": Report("salary_batches", lambda rows, _: salary.project_bank_rank(rows)),
    "salary_area_month": Report("salary_area_months"),
    "salary_area_totals": Report("salary_area_months", lambda rows, d: salary.area_totals(rows, d.tables.areas, d.as_of, d.city)),
    "salary_snapshot": Report("salary_batches", lambda rows, d: salary.salary_snapshot(rows, d.as_of)),
    "salary_detail": Report("salary_detail"),
    "salary_total": Report("salary_lines", lambda rows, d: salary.salary_total(rows, d.as_of)),
    "monthly_metrics": Report("metrics"),
    "labourer_history": Report("labourer_history"),
    "onjob_share": Report("labourer_history", lambda rows, d: labourers.onjob_share(rows, d.tables.areas, d.city)),
    "labourer_totals": Report("labourer_history", lambda rows, d: labourers.labourer_totals(rows, d.as_of)),
    "resumes": Report("resumes"),
    "onjob_by_type": Report("resumes", lambda rows, _: labourers.onjob_by_type(rows)),
    **{f"platform_totals_{u}": Report("resumes", lambda rows, d, u=u: attendance.platform_totals(rows, d.as_of, u)) for u in ("day", "month", "year")},
    **{f"project_totals_{u}": Report("resumes", lambda rows, d, u=u: attendance.project_totals(rows, d.as_of, u)) for u in ("day", "month", "year")},
    "company_project_types": Report("company_project_types"),
    "company_totals": Report("company_project_types", lambda rows, d: companies.company_totals(rows, d.tables.areas, d.as_of, d.city)),
    "company_area_totals": Report("company_project_types", lambda rows, d: companies.company_area_totals(rows, d.tables.areas, d.as_of, d.city)),
    "build_area_types": Report("project_days", lambda rows, _: projects.build_area_types(rows)),
    "build_day": Report("build_days"),
    "build_total": Report("build_days", lambda rows, _: projects.build_total(rows)),
    "status_day": Report("project_days", lambda rows, _: projects.status_day(rows)),
}


def run_reports(
    spark: SparkSession,
    tables: object | Mapping[str, DataFrame],
    as_of: dt.date,
    city: str,
    write: Callable[[str, DataFrame], None],
    names: Sequence[str] = tuple(REPORTS),
) -> int:
    """Makes the named reports and hands each to ``write``, which must store it. Shared details are computed once for
    all of them and removed when no report is left that reads them, also after an error. Reports come in the order of the
    details they build on. Returns the number of details stored."""
    unknown = [n for n in names if n not in REPORTS]
    if unknown:
        raise ValueError(f"unknown reports {unknown}; there are {sorted(REPORTS)}")
    source = SimpleNamespace(**tables) if isinstance(tables, Mapping) else tables
    with Run(spark, f"reports-{as_of}") as run:
        details = Details(run, source, as_of, city, numbered="salary_detail" in names)
        groups: dict[str, list[str]] = {}
        for name in names:
            groups.setdefault(details.first(REPORTS[name].detail), []).append(name)
        for first, together in groups.items():
            for name in together:
                with passing(spark):
                    write(name, REPORTS[name](details))
            details.drop(first)
        return len(run)
