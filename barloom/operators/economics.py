"""What a contract's price step is worth and what margin it takes, from specifications, rates, risk parameters and dated rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.operators.joins import asof

#: Fixed value: which clearing's rate of a day counts first.
CLEARINGS = {"tc": 1, "mc": 2}


def one_rate(rates: DataFrame) -> DataFrame:
    """currency, rate_date, rate: of a day's rates (clearing, rate) that of the first clearing."""
    place = F.create_map(*(F.lit(x) for kv in CLEARINGS.items() for x in kv))
    order = F.struct(F.coalesce(place[F.col("clearing")], F.lit(len(CLEARINGS) + 1)).alias("p"), F.col("clearing").alias("c"))
    return rates.groupBy("currency", "rate_date").agg(F.min_by("rate", order).alias("rate"))


def economics(specs: DataFrame, rates: DataFrame, risk: DataFrame, rules: DataFrame, home: str = "RUB", linked: tuple[str, ...] = ()) -> DataFrame:
    """One row per contract and trade date with step_price, its source, tick_value, margins, and until when they hold.

    specs: contract_id, asset, trade_date, currency, min_step, lot, official_step_price, settle, official_margin.
    risk: asset, risk_date, mr1, radius_pct; the last at or before the date counts. rules: asset, valid_from, valid_to, rule_currency,
    rule_min_step, rule_lot, tick_value_quote; a small table. The official step price counts if it is positive, else the rule's tick value
    at the rate of its currency, if the rule's step and lot are the contract's; else it is unavailable. The radius applies to other
    currencies than home, and to linked assets. A factor per asset, the least official margin over the computed one at its last date,
    scales the margin down to the official one.
    """
    c = F.col
    dated = rules.select("asset", "valid_from", "valid_to", "rule_currency", "rule_min_step", "rule_lot", "tick_value_quote").withColumnRenamed("asset", "_asset")
    out = specs.join(F.broadcast(dated), (c("asset") == c("_asset")) & c("trade_date").between(c("valid_from"), c("valid_to")), "left")  # a small table
    out = asof(out, risk, ["asset"], "trade_date", "risk_date", ["mr1", "radius_pct"])
    daily = one_rate(rates)
    for currency, name in (("currency", "fx_rate"), ("rule_currency", "step_rate")):
        day = daily.select(c("currency").alias(f"_{name}_of"), c("rate_date").alias(f"_{name}_day"), c("rate").alias(f"_{name}"))
        out = out.join(day, (c(currency) == c(f"_{name}_of")) & (c("trade_date") == c(f"_{name}_day")), "left")
        out = out.withColumn(name, F.when(c(currency) == home, F.lit(1.0)).otherwise(c(f"_{name}"))).drop(f"_{name}_of", f"_{name}_day", f"_{name}")
    same = (F.abs(c("min_step") - c("rule_min_step")) <= 1e-12) & (F.abs(c("lot") - c("rule_lot")) <= 1e-12)
    by_rule = F.when(same, c("tick_value_quote") * c("step_rate"))
    official = c("official_step_price") > 0
    out = out.withColumn("_by_rule", by_rule).withColumns(
        {
            "step_price": F.when(official, c("official_step_price")).otherwise(c("_by_rule")),
            "step_source": F.when(official, "official").when(c("_by_rule") > 0, "rule").otherwise("unavailable"),
        }
    )
    applies = (c("currency") != home) | c("asset").isin(list(linked))
    radius = F.when(applies, c("radius_pct")).otherwise(F.lit(0.0))
    out = out.withColumns({"tick_value": F.when(c("currency") == home, c("step_price")).otherwise(c("step_price") / c("fx_rate")), "margin_base": c("settle") * (c("step_price") / c("min_step")) * c("mr1")})
    out = out.withColumn("margin_radius", c("margin_base") * (1 + radius / 100))
    out = out.withColumn("effective_to", F.lead("trade_date").over(Window.partitionBy("contract_id").orderBy("trade_date")))
    last = out.where("official_margin > 0 AND margin_radius > 0").groupBy(c("asset").alias("_of")).agg(F.max("trade_date").alias("_last"))
    known = out.join(last, (c("asset") == c("_of")) & (c("trade_date") == c("_last")), "left_semi").where("official_margin > 0 AND margin_radius > 0")
    factor = known.groupBy(c("asset").alias("_of")).agg(F.min(c("official_margin") / c("margin_radius")).alias("factor"))
    out = out.join(factor, c("asset") == c("_of"), "left")
    return out.withColumn("margin", c("margin_radius") * c("factor")).drop("_of", "_asset", "_by_rule", "matched_risk_date")
