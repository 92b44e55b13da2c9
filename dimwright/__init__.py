"""dimwright: a Spark-native engine for dated batch feeds.

Raw records are read under a declared schema, validated by declarative
rules, de-duplicated with a total order, folded into slowly changing
dimensions (type 1, type 2, insert-only), loaded into a star schema and
measured by data-quality metrics.  Every step is a DataFrame -> DataFrame
function built from Spark built-ins; nothing is collected to the driver
except control-table scalars.
"""

from dimwright.contract import (  # noqa: F401
    DedupSpec,
    DimensionSpec,
    FactSpec,
    FeedSpec,
    Rule,
    FieldRules,
    contract_from_dict,
)

__all__ = [
    "DedupSpec",
    "DimensionSpec",
    "FactSpec",
    "FeedSpec",
    "Rule",
    "FieldRules",
    "contract_from_dict",
]
