from helpers import event, events_df
from pyspark.sql import functions as F

from logloom.plans import incremental as INC

L = 1_700_000_000_000


def test_next_watermark_default_and_strict_d2(spark):
    evs = events_df(spark, [event(1, L + 5000), event(2, L + 9000), event(3, L + 7000)])
    wm = INC.next_watermark(evs, L).first()
    assert (wm.next_watermark, wm.has_millis, wm.audit_records) == (L + 9000, False, 3)
    # strict: the last row received (by page, then position), not the newest
    paged = evs.select("eventDate", F.lit(0).alias("page"),
                       F.when(F.col("id") == "3", 9).otherwise(F.col("id").cast("int")).alias("pos"))
    assert INC.next_watermark_strict(paged, L).first().next_watermark == L + 7000


def test_next_watermark_with_nothing_new(spark):
    evs = events_df(spark, [event(1, L - 10)])
    wm = INC.next_watermark(evs, L).first()
    assert (wm.next_watermark, wm.audit_records) == (L, 0)
    empty = evs.where("false").select("eventDate", F.lit(0).alias("page"), F.lit(0).alias("pos"))
    assert INC.next_watermark_strict(empty, L).first().next_watermark == L + 1
    assert INC.incremental_count(evs, L).first().audit_records == 0
    assert INC.next_watermark(events_df(spark, [event(1, L + 1500)]), L).first().has_millis
