"""Name -> query callable ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundlens.plans import campaign_queries as C
from fundlens.plans import feature_queries as FQ
from fundlens.plans import io_queries as IO
from fundlens.plans import stream_queries as SQ
from fundlens.plans import train_queries as TQ
from fundlens.plans import text_queries as T
from fundlens.plans.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    # step 1
    "word_count": T.word_count,
    "word_count_lower": T.word_count_lower,
    "top_words": T.top_words,
    "top_words_lower": T.top_words_lower,
    "line_and_token_totals": T.line_and_token_totals,
    # step 2
    "campaign_cast": C.campaign_cast,
    "campaign_cast_truncating": C.campaign_cast_truncating,
    "campaign_country": C.campaign_country,
    "campaign_currency": C.campaign_currency,
    "campaign_status_recode": C.campaign_status_recode,
    "campaign_status_drop": C.campaign_status_drop,
    "campaign_durations": C.campaign_durations,
    "campaign_prep_repair": C.campaign_prep_repair,
    "campaign_text": C.campaign_text,
    "campaign_fill": C.campaign_fill,
    "campaign_prepare": C.campaign_prepare,
    "campaign_prepare_drop": C.campaign_prepare_drop,
    "campaign_prepare_drop_negative": C.campaign_prepare_drop_negative,
    "shortest_preparations": C.shortest_preparations,
    "filled_counts": C.filled_counts,
    # step 3
    "status_counts": C.status_counts,
    "country_currency_counts": C.country_currency_counts,
    "disable_communication_counts": C.disable_communication_counts,
    "country_counts": C.country_counts,
    "currency_counts": C.currency_counts,
    "backers_counts": C.backers_counts,
    "state_changed_counts": C.state_changed_counts,
    "flag_counts": C.flag_counts,
    "profile_all": C.profile_all,
    "negative_prep_counts": C.negative_prep_counts,
    "false_country_currencies": C.false_country_currencies,
    "describe_numeric": C.describe_numeric,
    "null_audit": C.null_audit,
    "distinct_deadlines": C.distinct_deadlines,
    "largest_goals": C.largest_goals,
    "class_balance": C.class_balance,
    "first_campaigns": C.first_campaigns,
    "one_campaign": C.one_campaign,
    "vote_tally": C.vote_tally_query,
    # step 4
    "tokens": FQ.tokens,
    "tokens_no_stop": FQ.tokens_no_stop,
    "term_counts": FQ.term_counts,
    "tfidf": FQ.tfidf,
    "category_index": FQ.category_index,
    "category_index_large": FQ.category_index_large,
    "vocabulary_bounded": FQ.vocabulary_bounded,
    "one_hot": FQ.one_hot,
    # step 5
    "split_counts": FQ.split_counts,
    "confusion": FQ.confusion,
    "f1": FQ.f1,
    "accuracy": FQ.accuracy,
    # step 6
    "train_score": TQ.train_score,
    "grid_search": TQ.grid_search,
    "model_reload": TQ.model_reload,
    "model_stationarity": TQ.model_stationarity,
    "model_confusion": TQ.model_confusion,
    "model_parameters": TQ.model_parameters,
    # step 7
    "stream_replay": SQ.stream_replay,
    "stream_resume": SQ.stream_resume,
    "stream_heartbeat": SQ.stream_heartbeat,
    "stream_feed": SQ.stream_feed,
    "stream_consumers": SQ.stream_consumers,
    # step 8
    "csv_roundtrip": IO.csv_roundtrip,
    "csv_inferred": IO.csv_inferred,
    "prepare_observed": IO.prepare_observed,
    "word_count_cached": IO.word_count_cached,
    "text_roundtrip": IO.text_roundtrip,
    "single_file_export": IO.single_file_export,
    "campaign_csv_prepare": IO.campaign_csv_prepare,
    "udf_clean": IO.udf_clean,
    "udf_types": IO.udf_types,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
