from __future__ import annotations

from loanlens.plans.views import view
from loanlens.session import split_wide_methods

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_queries_split_methods_the_jvm_would_not_compile(spark):
    before = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "65535")
        view(spark, "/root/testdata/sf0.001", "origination")
        assert spark.conf.get(LIMIT) == "8000"
        spark.conf.set(LIMIT, "4000")
        split_wide_methods(spark)
        assert spark.conf.get(LIMIT) == "4000"
    finally:
        spark.conf.set(LIMIT, before)
