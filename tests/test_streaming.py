import os
import tempfile

from fixtures import SALES_LINES, base_tables, sales_text
from kubus.operators import dims as D
from kubus.sources.sales_text import write_sales_csv
from kubus.streaming.sales_stream import loaded_fact, loaded_rejects, start_sales_load


def test_stream_load_matches_batch_counts(spark):
    t = base_tables(spark)
    shop = D.shop_dimension(t["shop"], t["city"], t["region"], t["country"])
    product = D.product_dimension(t["article"], t["group"], t["family"], t["category"])
    cal = D.calendar(spark, 2019, 2020)
    tmp = tempfile.mkdtemp(prefix="kubus-stream-")
    inbox = os.path.join(tmp, "inbox")
    write_sales_csv(sales_text(spark), os.path.join(inbox, "batch1"))
    q = start_sales_load(spark, os.path.join(inbox, "*"), shop, product, cal,
                         os.path.join(tmp, "out"), os.path.join(tmp, "ckpt"))
    q.awaitTermination(120)
    accepted = sum(1 for _, r in SALES_LINES if r is None)
    assert loaded_fact(spark, os.path.join(tmp, "out")).count() == accepted
    assert loaded_rejects(spark, os.path.join(tmp, "out")).count() == len(SALES_LINES) - accepted
