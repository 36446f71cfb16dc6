"""ledgerguard: Spark-native fraud scoring and alert prioritisation.

A library of DataFrame -> DataFrame operators over a transaction table:
as-of behavioural features (window functions), an auditable rule catalogue,
learned and outlier scores, an expected-loss queue, capacity / cost driven
thresholds, ranking metrics, drift statistics, data-quality checks and
analyst aggregates.
"""

__version__ = "0.1.0"
