"""The revenue forecast (order-side revenue plus CRM schedules)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.fiscal import fiscal_year_label
from ..functions.rules import (inclusion_flag, is_pipeline, owner, project_stage_code,
                               revenue_code, weighted)
from ..functions.semantics import exclude_keep_null
from ..operators.projection import move_first, select_renamed
from ..operators.sets import union_by_name
from .config import ForecastConfig


def forecast_frame(df: DataFrame) -> DataFrame:
    """Project a fact onto the shared forecast columns (renamed, first
    present source wins) with the order number as text."""
    out = select_renamed(df, K.FORECAST_COLUMNS)
    if "OrderNum" in out.columns:
        out = out.withColumn("OrderNum", F.col("OrderNum").cast("string"))
    if "RevID" in out.columns:
        out = out.withColumn("RevID", F.col("RevID").cast("string"))
    return out


def revenue_forecast(order_revenue: DataFrame, crm_fact: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Union order-side revenue and CRM transactions, code them, weight the
    pipeline by probability, flag what counts, drop test accounts and
    excluded fiscal years (null values kept), and pick the owner."""
    fc = union_by_name([forecast_frame(order_revenue), forecast_frame(crm_fact)])
    pipe = is_pipeline("RevID")
    fc = (fc.withColumn("Proj_Stage", project_stage_code("Proj_Stage"))
          .withColumn("RevID", revenue_code("RevID", "Proj_Stage"))
          .withColumn("wfc", weighted("Amount", "Opp_Prob", pipe))
          .withColumn("Opps_WAmount", weighted("Opps_UnWAmount", "Opp_Prob", pipe))
          .withColumn("unwfc", F.col("Amount").cast("double"))
          .withColumn("revFY", fiscal_year_label("revFYFP"))
          .withColumn("fc_filter", inclusion_flag("revFYFP", "RevID", "Opp_Prob",
                                                  cfg.last_legacy_period, cfg.first_new_period)))
    fc = move_first(fc, "fc_filter")
    fc = (fc.where(exclude_keep_null("Account", cfg.test_accounts))
          .where(exclude_keep_null("revFY", cfg.excluded_fiscal_years)))
    return fc.drop("Amount").withColumn("owner", owner(pipe, "OppOwner", "AcctOwner"))
