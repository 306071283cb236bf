"""Named relations over one set of model tables, each built when first asked for."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cleaning, cohorts, customers, features, ltv, rfm
from tidemark.operators.churn import risk_tier
from tidemark.functions.fixedpoint import round_half_up
from tidemark.params import Params
from tidemark.session import materialise
from tidemark.sources import Tables


class Workspace:
    """The load step of the analysis: raw tables in, cleaned and derived relations out."""

    def __init__(self, tables: Tables, p: Params):
        self.raw = tables
        self.p = p

    @cached_property
    def base(self) -> Tables:
        return cleaning.clean_tables(self.raw, self.p)

    @cached_property
    def clean(self) -> DataFrame:
        return cleaning.orders_clean(self.raw.orders, self.p)

    @cached_property
    def customers(self) -> DataFrame:
        return cleaning.clean_city(self.raw.customers)

    @cached_property
    def customer_stats(self) -> DataFrame:
        return customers.customer_stats(self.clean, self.customers, self.p)

    @cached_property
    def purchase_intervals(self) -> DataFrame:
        return customers.purchase_intervals(self.clean)

    @cached_property
    def rfm_raw(self) -> DataFrame:
        return rfm.rfm_raw(self.clean, self.p)

    @cached_property
    def rfm_segments(self) -> DataFrame:
        return rfm.rfm_segments(rfm.rfm_scores(self.rfm_raw))

    @cached_property
    def retention(self) -> DataFrame:
        return cohorts.cohort_retention(self.clean, self.p)

    @cached_property
    def features(self) -> DataFrame:
        return features.ml_features(self.clean, self.raw.items, self.raw.products, self.customers, self.p)

    @cached_property
    def feature_table(self) -> DataFrame:
        """The features as a table: models read them many times."""
        return materialise(self.features)

    @cached_property
    def rule_master(self) -> DataFrame:
        """A customer master without fitted models.

        Rule-based segment, a churn score that falls with the order count, and a run-rate
        value stand in for K-Means, the classifier and the regressor. Every report and
        dashboard query can be checked on it against SQL.
        """
        labelled = rfm.with_band_scores(self.features).withColumns(
            {"segment_label": rfm.segment_label(), "churn_prob": F.expr("5D / (frequency + 5D)")}
        )
        valued = ltv.ltv_heuristic(labelled, self.p).withColumn(
            "ltv_predicted", round_half_up(F.col("avg_order_value") * F.col("orders_per_month") * 12, 2)
        )
        graded = ltv.ltv_tiers(valued, "ltv_predicted")
        return graded.withColumns(
            {
                "churn_risk_tier": risk_tier(F.col("churn_prob"), self.p),
                "prediction": F.expr("CASE WHEN churn_prob > 0.5 THEN 1 ELSE 0 END"),
            }
        )

    def datasets(self) -> Mapping[str, DataFrame]:
        """The ten datasets of the analysis under their public names. Each is built when it is asked for, not before:
        a global order, as in ``rfm_segments``, runs jobs.

        ``order_gaps`` holds the purchase intervals: that is what the name has always meant.
        """
        return Lazy(
            {
                "customers": lambda: self.base.customers,
                "orders": lambda: self.base.orders,
                "order_items": lambda: self.base.items,
                "products": lambda: self.base.products,
                "customer_stats": lambda: self.customer_stats,
                "rfm_segments": lambda: self.rfm_segments,
                "ml_features": lambda: self.features,
                "cohort_retention": lambda: self.retention,
                "cohort_revenue": lambda: cohorts.cohort_revenue(self.clean, self.p),
                "order_gaps": lambda: self.purchase_intervals,
            }
        )

    def views(self) -> Mapping[str, DataFrame]:
        """The relations that SQL statements name: base tables, clean orders, and what is derived from them."""
        return Lazy(
            {
                **{name: (lambda name=name: self.datasets()[name]) for name in ("customers", "orders", "order_items", "products")},
                "v_orders_clean": lambda: self.clean,
                "v_items_clean": lambda: cleaning.items_clean(self.raw.items, self.clean),
                "v_customer_stats": lambda: self.customer_stats,
                "v_order_gaps": lambda: customers.order_gaps(self.clean),
                "v_purchase_intervals": lambda: self.purchase_intervals,
                "v_product_mix": lambda: customers.product_mix(self.raw.items, self.clean, self.raw.products),
                "v_rfm_raw": lambda: self.rfm_raw,
                "v_rfm_segments": lambda: self.rfm_segments,
                "v_cohort_base": lambda: cohorts.cohort_base(self.clean),
                "v_cohort_retention": lambda: self.retention,
                "v_cohort_revenue": lambda: cohorts.cohort_revenue(self.clean, self.p),
                "v_ml_features": lambda: self.features,
            }
        )

    def register(self, *names: str) -> None:
        """Make :meth:`views` (all of them, or those named) temporary views of the session, to be read by ``spark.sql``."""
        views = self.views()
        for name in names or views:
            views[name].createOrReplaceTempView(name)

    def sql(self, statement: str) -> DataFrame:
        """The result of a statement over the views. Only the ones it names are built."""
        named = set(re.findall(r"\w+", statement.lower()))
        self.register(*(name for name in self.views() if name in named))
        return self.raw.orders.sparkSession.sql(statement)


class Lazy(Mapping):
    """A read-only mapping whose values are made when they are first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers = makers
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)
