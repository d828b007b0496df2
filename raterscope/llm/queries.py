"""All queries of the subpackage; importing their modules registers them."""

from raterscope.llm import (  # noqa: F401
    bpe,
    centroids,
    fill_middle,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    neighbours,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    url_filters,
)
from raterscope.llm.common import ORACLE, QUERIES  # noqa: F401
