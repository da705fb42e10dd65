"""The corpus pipeline: STAGES, run(spark, sf_dir) and ORACLE_SQL, as lograil.llm.pipeline defines them."""

from lograil.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
