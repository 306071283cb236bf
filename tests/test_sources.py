"""CSV input, the dataset registry and the session rules."""

import pytest

from tidemark import Params
from tidemark.plans.workspace import Workspace
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.tables import read_csv_checked, read_csv_tables, read_parquet_tables, write_rejected

FILES = {
    "customers": "customer_id,city,signup_date,age,channel\nC1, Pune ,2022-01-05,30,Organic\nC2,Delhi,2022-02-01,41,Ads\n",
    "orders": "order_id,customer_id,order_date,total_amount,discount_applied,discount_percentage\n"
    "O1,C1,2024-06-01,100.0,Yes,10\nO2,C1,2024-06-11,50.0,No,0\nO2,C1,2024-06-11,50.0,No,0\n",
    "order_items": "order_id,product_id,quantity,price,line_total\nO1,P1,1,100,90.0\nO2,P2,2,25,50.0\nO9,P1,1,5,5.0\n",
    "products": "product_id,category,product_name,unit_price,margin_pct\nP1,mayo,Classic,100,0.5\nP2,dips,Salsa,25,0.4\n",
}


@pytest.fixture()
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_csv_tables_end_to_end(spark, folder):
    datasets = Workspace(read_csv_tables(spark, folder), Params()).datasets()
    assert list(datasets) == [
        "customers", "orders", "order_items", "products", "customer_stats",
        "rfm_segments", "ml_features", "cohort_retention", "cohort_revenue", "order_gaps",
    ]
    counts = {name: df.count() for name, df in datasets.items()}
    assert counts["orders"] == 2 and counts["order_items"] == 2 and counts["customer_stats"] == 1
    row = datasets["ml_features"].first()
    assert (row.city, row.monetary, row.mayo_spend_share, row.dips_spend_share) == ("Pune", 150.0, 0.667, 0.333)
    assert datasets["order_gaps"].first().avg_purchase_interval_days == 10.0


def test_parquet_tables(spark, folder, tmp_path):
    for name, df in zip(FILES, read_csv_tables(spark, folder)):
        df.write.parquet(f"{tmp_path}/lake/{name}")
    tables = read_parquet_tables(spark, f"{tmp_path}/lake")
    assert tables.orders.count() == 3 and dict(tables.orders.dtypes)["order_date"] == "date"


def test_wrong_header_is_rejected(spark, folder, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,kind,product_name,unit_price,margin_pct\nP1,mayo,x,1,1\n")
    with pytest.raises(Exception, match="CSV header|header"):
        read_csv_tables(spark, folder).products.collect()


def test_configured_checkpoint_folder_wins():
    class Context:
        master = "spark://cluster:7077"
        chosen = None

        def getCheckpointDir(self):
            return self.chosen

        def setCheckpointDir(self, folder):
            self.chosen = folder

    class Conf(dict):
        pass

    class Session:
        def __init__(self, **conf):
            self.sparkContext, self.conf = Context(), Conf(conf)

    shared = Session(**{"spark.checkpoint.dir": "hdfs:///shared"})
    ensure_checkpoint_dir(shared)
    assert shared.sparkContext.chosen == "hdfs:///shared"
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_rejected_rows_are_kept_and_counted(spark, folder, tmp_path):
    bad = ["O7,C2,2024-06-11,abc,No,0", "O8,C2,2024-13-45,10.0,No,0", "O9,C2", "O10,C2,2024-06-11,5.0,No,0,extra"]
    fine = ["O11,C2,2024-06-12,,No,0", ",C2,2024-06-12,7.5,,", 'O12,"C,2",2024-06-12,7.5,Yes,12.5']
    with open(f"{folder}/orders.csv", "a") as file:
        file.write("".join(line + "\n" for line in bad + fine))
    orders = read_csv_checked(spark, folder).orders
    rows = orders.collect()
    assert [r.order_id for r in rows] == ["O1", "O2", "O2", "O11", None, "O12"]
    assert [tuple(r) for r in write_rejected(spark, folder, f"{tmp_path}/rejects").collect()] == [("orders", 4)]
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/rejects").collect())) == sorted(("orders", line) for line in bad)
    assert orders.count() == 6
    narrow = orders.select("order_id").collect()  # pruning a bad column away doesn't let its row in
    assert len(narrow) == 6
    datasets = Workspace(read_csv_checked(spark, folder), Params()).datasets()
    assert datasets["orders"].count() == 5  # without the copy; a NULL amount is not "<= 0" and stays


def test_views_are_read_by_sql(spark, folder):
    work = Workspace(read_csv_tables(spark, folder), Params())
    found = work.sql("SELECT f.customer_id, s.total_revenue FROM v_ml_features f JOIN V_CUSTOMER_STATS s USING (customer_id)").collect()
    assert [tuple(r) for r in found] == [("C1", 150.0)]
    work.register()
    for name, frame in work.views().items():
        assert spark.table(name).columns == frame.columns
    assert spark.sql("SELECT COUNT(*) FROM v_order_gaps").first()[0] == 1


def test_datasets_start_no_job(spark, folder):
    work = Workspace(read_csv_tables(spark, folder), Params())
    tracker, group = spark.sparkContext.statusTracker(), "datasets"
    spark.sparkContext.setJobGroup(group, "none")
    try:
        datasets = work.datasets()
        assert len(datasets) == 10 and "rfm_segments" in list(datasets)
        assert datasets["customer_stats"] is datasets["customer_stats"]
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
