"""Print the formatted physical plans of the main steps.

Usage: python tools/show_plans.py [sf_dir]

Shows the measure-cube job over the raw tables (pre-aggregation before the
order join, pushed filters, AQE join choice) and the plans that read the
written cube (filters pushed into its scan, one shuffle per aggregate).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelforge.plans.analytics import Extracts  # noqa: E402
from panelforge.session import build_session  # noqa: E402
from panelforge.sources.extracts import read_cube, recipes  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    sections = {
        "measure cube (raw tables)": read_cube(spark, sf_dir, recipes().values()),
    }
    ex = Extracts(spark, sf_dir)
    sections["load_employed (from the written cube)"] = ex.load("employed")
    sections["stg_hours_worked"] = ex.stage("hours_worked")
    sections["gender_gap"] = ex.final("gender_gap")
    for title, df in sections.items():
        print(f"\n===== {title} =====")
        df.explain("formatted")


if __name__ == "__main__":
    main()
