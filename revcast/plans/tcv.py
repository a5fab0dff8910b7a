"""The total-contract-value forecast (actuals, pipeline, unreported)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.fiscal import fiscal_year_label
from ..functions.rules import (owner, pipeline_weighted_tcv, tcv_period, unweighted_tcv,
                               weighted, weighted_tcv)
from ..functions.semantics import exclude_keep_null
from ..operators.joins import anti_join
from ..operators.sets import union_by_name
from .config import ForecastConfig
from .revenue import forecast_frame


def unreported_opportunities(opps: DataFrame, reported: DataFrame) -> DataFrame:
    """Opportunities whose number does not occur among the reported
    ones (a null number counts as reported when a null was reported)."""
    out = anti_join(opps, reported, "Opps_Opportunity__c", "Opp_Num", null_safe=True)
    return (out.drop("Opps_Id").withColumnsRenamed(K.UNREPORTED_RENAMES)
            .withColumn("src", F.lit(K.SRC_UNREPORTED)))


def tcv_forecast(order_tcv: DataFrame, pipeline: DataFrame, opportunities: DataFrame,
                 cfg: ForecastConfig) -> DataFrame:
    """Actual TCV and pipeline TCV by name, plus opportunities reported in
    neither; periods, weights, exclusions and owner as in the original."""
    actual = forecast_frame(order_tcv).withColumn("src", F.lit(K.SRC_ACTUAL))
    pipe = forecast_frame(pipeline).withColumn("src", F.lit(K.SRC_PIPELINE))
    fc = union_by_name([actual, pipe])
    fc = union_by_name([fc, unreported_opportunities(opportunities, fc)])
    fc = fc.withColumnRenamed("revFYFP", "trxFYFP")
    is_pipe = F.col("src") == K.SRC_PIPELINE
    fc = (fc.withColumn("tcvFYFP", tcv_period("src", "trxFYFP", "Opp_CloseMonth"))
          .withColumn("tcvFY", fiscal_year_label("tcvFYFP"))
          .withColumn("unw_fc_tcv", unweighted_tcv("src", "Amount", "TCV_UnWPL"))
          .withColumn("w_fc_tcv", weighted_tcv("src", "unw_fc_tcv", "Opp_Prob")))
    fc = (fc.where(exclude_keep_null("Account", cfg.test_accounts))
          .where(exclude_keep_null("tcvFY", cfg.excluded_fiscal_years)))
    fc = (fc.withColumn("w_pl_tcv", pipeline_weighted_tcv("src", "unw_fc_tcv", "Opp_Prob"))
          .withColumnsRenamed({"TCV_UnWPL": "unw_pl_tcv", "Amount": "actual_tcv"})
          .withColumn("Opps_WAmount", weighted("Opps_UnWAmount", "Opp_Prob", is_pipe))
          .withColumn("owner", owner(is_pipe, "OppOwner", "AcctOwner")))
    return fc
