"""Registry of the queries run on the driver tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martforge.plans import (activity, activity_marts, contact_marts, crm, crm_extracts, crm_marts, extracts, pages,
                             spend, web, web_marts, workspace)

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {
    "web_daily_attribution": web.web_daily_attribution,
    "fill_down_up": web.fill_down_up,
    "fill_down_then_up": web.fill_down_then_up,
    "landing_value": web.landing_value,
    "mode_first_seen": web.mode_first_seen,
    "stage_change_points": web.stage_change_points,
    "anti_join_exclusions": activity.anti_join_exclusions,
    "top_k_by_count": activity.top_k_by_count_q,
    "not_like_keep_null": activity.not_like_keep_null,
    "inner_same_day": activity.inner_same_day,
    "first_contact_min": activity.first_contact_min,
    "strict_min_max": activity.strict_min_max,
    "engagement_summary": activity.engagement_summary,
    "pivot_counts": activity.pivot_counts,
    "pivot_first_ts": activity.pivot_first_ts,
    "null_flags": activity.null_flags,
    "hours_between": activity.hours_between_q,
    "minute_trunc": activity.minute_trunc_q,
    "epoch_ms": activity.epoch_ms,
    "date_spine_weeks": activity.date_spine_weeks,
    "fill_by_type": activity.fill_by_type_q,
    "lookup_top_k": activity.lookup_top_k,
    "union_all_tagged": activity.union_all_tagged,
    "daily_activity_detail": activity.daily_activity_detail,
    "latest_version": crm.latest_version_q,
    "latest_version_distinct": crm.latest_version_distinct,
    "latest_composite_key": crm.latest_composite_key,
    "top_row_per_group": crm.top_row_per_group,
    "latest_then_terminal": crm.latest_then_terminal,
    "latest_then_aggregate": crm.latest_then_aggregate,
    "stage_rollup": crm.stage_rollup,
    "null_safe_left_join": crm.null_safe_left_join_q,
    "star_join": crm.star_join,
    "two_role_join": crm.two_role_join,
    "on_clause_constant": crm.on_clause_constant,
    "membership_join": crm.membership_join,
    "count_distinct_having": crm.count_distinct_having,
    "string_agg_distinct": crm.string_agg_distinct_q,
    "code_map_two_else": crm.code_map_two_else,
    "calendar_columns": crm.calendar_columns_q,
    "concat_forms": crm.concat_forms,
    "literal_table_join": crm.literal_table_join,
    "cond_sum": crm.cond_sum,
    "sentinel_row": crm.sentinel_row,
    "fanout_join": crm.fanout_join,
    "composite_left_join": crm.composite_left_join,
    "or_and_precedence": crm.or_and_precedence,
    "similar_to_class": crm.similar_to_class,
    "spend_union": spend.spend_union,
    "spend_allocation": spend.spend_allocation,
    "url_split": pages.url_split,
    "url_params": pages.url_params,
    "distinct_dim_enrich": pages.distinct_dim_enrich,
    "attributed_pageviews": web_marts.attributed_pageviews_q,
    "daily_visitors": web_marts.daily_visitors_q,
    "form_conversions": web_marts.form_conversions_q,
    "user_agents": web_marts.user_agents_q,
    "ip_range_lookup": web_marts.ip_range_lookup_q,
    "deal_stage_history": crm_marts.deal_stage_history_q,
    "deal_mart": crm_marts.deal_mart_q,
    "contact_mart": contact_marts.contact_mart_q,
    "activity_summary": activity_marts.activity_summary_q,
    "activity_detail": activity_marts.activity_detail_q,
    "geo_hierarchy": activity_marts.geo_hierarchy_q,
    "marketing_spend": spend.marketing_spend_q,
    "marketing_spend_allocated": spend.marketing_spend_allocated_q,
    "meeting_bookings": workspace.meeting_bookings_q,
    "contracts": workspace.contracts_q,
    "teams": workspace.teams_q,
    "spaces": workspace.spaces_q,
    "pipeline_moves": extracts.pipeline_moves_q,
    "second_pipeline_history": extracts.second_pipeline_history_q,
    "form_hits": extracts.form_hits_q,
    "deleted_deals": extracts.deleted_deals_q,
    "tours": extracts.tours_q,
    "access_events": extracts.access_events_q,
    "crm_activity": extracts.crm_activity_q,
    "lifecycle_history": extracts.lifecycle_history_q,
    "deals_with_owner": extracts.deals_with_owner_q,
    "stage_probabilities": extracts.stage_probabilities_q,
    "crm_leads": extracts.crm_leads_q,
    "chatter_posts": extracts.chatter_posts_q,
    "crm_opportunities": crm_extracts.crm_opportunities_q,
    "opportunity_roles": crm_extracts.opportunity_roles_q,
    "deal_contact_links": crm_extracts.deal_contact_links_q,
    "deal_company_links": crm_extracts.deal_company_links_q,
    "companies": crm_extracts.companies_q,
    "contact_engagements": contact_marts.contact_engagements_q,
    "engagements_by_contact": contact_marts.engagements_by_contact_q,
    "phone_call_log": contact_marts.phone_call_log_q,
    "tours_and_calls": contact_marts.tours_and_calls_q,
    "rep_engagements": activity_marts.rep_engagements_q,
    "rep_tasks": activity_marts.rep_tasks_q,
}
