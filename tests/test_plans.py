"""Plan properties that must hold at scale: column pruning and filter
pushdown reach the scan, no cartesian or nested-loop joins, and the pair
stage is not coalesced by AQE."""

import pytest

from basketflow.plans import batch, ml, streams
from tests.conftest import SF


def formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("query", [batch.cooc_pairs, batch.cooc_recs_text,
                                   batch.cooc_customer_pairs, batch.cooc_pairs_blocked])
def test_pair_plans_have_no_cartesian_join(spark, query):
    text = formatted(query(spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_pair_scan_reads_two_columns(spark):
    text = formatted(batch.cooc_pairs(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text


def test_block_shuffle_has_pinned_partitions(spark):
    # REPARTITION_BY_NUM is never coalesced by AQE
    text = formatted(batch.cooc_pairs(spark, SF))
    assert "REPARTITION_BY_NUM" in text


def test_word_count_reads_text_only(spark):
    text = formatted(batch.wc_batch(spark, SF))
    assert "ReadSchema: struct<text:string>" in text


def test_labelled_documents_skip_text(spark):
    text = formatted(ml.labelled_documents(spark, SF))
    assert "text:string" not in text


def test_event_slice_filter_is_pushed(spark):
    df = (streams.event_view_slices(spark, SF).where(streams.in_event_slice(1))
          .select("value"))
    text = formatted(df)
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
