"""Registered queries: features, labels, predictions and views stored in
buckets by visitor, and their joins without an exchange."""

from __future__ import annotations

import uuid

from kindred.operators.compare import compare_populations, mix_of_views, visitor_views
from kindred.operators.features import build_wide
from kindred.plans import stages as st
from kindred.plans.catalog import CFG, W, fixtures, out, register
from kindred.plans.checks_compare import CM, ROUND_CMP
from kindred.plans.oracle_sql import feature_ctes
from kindred.sources.buckets import read_bucketed, write_bucketed
from kindred.sources.session import scratch_path


def stored(df, name: str):
    """``df`` by visitor, read back through its description."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    write_bucketed(df, path, "visitor_id")
    return read_bucketed(df.sparkSession, path)


@register("stored_training_set", f"""{W},
{feature_ctes(CFG, "pageviews", "sb_")},
sb_labels AS (SELECT visitor_id, CASE WHEN management_level = 'C-Level' THEN 1 ELSE 0 END AS c_level,
    min(management_level) AS management_level FROM seed_labels WHERE visitor_id IS NOT NULL GROUP BY ALL)
SELECT visitor_id, l.c_level, l.management_level, round(s.session_pvs_mean, 6) AS session_pvs_mean
FROM sb_row JOIN sb_stats s USING (visitor_id) JOIN sb_labels l USING (visitor_id)""")
def q_stored_training_set(spark, sf):
    """Stored features joined with stored labels."""
    fx = fixtures(spark, sf)
    feats = stored(build_wide(fx.pageviews, CFG), "features")
    labels = stored(st.label_rows(fx.seed_labels), "labels")
    return out(st.training_set(feats, labels).select("visitor_id", "c_level", "management_level", "session_pvs_mean"))


@register("stored_compare", f"{CM}\nSELECT {ROUND_CMP} FROM cm_compare")
def q_stored_compare(spark, sf):
    """Both populations compared, from each visitor's stored views by category."""
    fx = fixtures(spark, sf)
    views = stored(visitor_views(fx.pageviews), "views")
    seen = st.labelled_views(views, stored(st.label_rows(fx.seed_labels), "labels"))
    found = st.scored_views(views, stored(fx.predictions, "predictions"))
    return out(compare_populations(mix_of_views(seen), mix_of_views(found)))
