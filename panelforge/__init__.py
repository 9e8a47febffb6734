"""panelforge: a Spark-native pipeline for annual panel indicators.

Wide statistical extracts (dimension columns plus one column per year) are
landed, reshaped to long form, filtered, pivoted into per-category columns,
joined on (country, year) and written by full replacement, keyed upsert or a
date-partitioned, country-clustered layout. Quality checks and trend analyses
run on the final tables. Everything is DataFrame code on built-in operators.
"""

from panelforge.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
