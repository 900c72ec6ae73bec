from cohortry.plans.insights import InsightTables, run_insights
from cohortry.plans.medallion import MedallionTables, run_medallion

__all__ = ["InsightTables", "MedallionTables", "run_insights", "run_medallion"]
