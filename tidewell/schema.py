"""Column sets of the record kinds and the types derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of comments (rc) and submissions (rs) in their order.
RC = """
all_awardings archived associated_award author author_cakeday author_created_utc author_flair_background_color
author_flair_css_class author_flair_richtext author_flair_template_id author_flair_text author_flair_text_color
author_flair_type author_fullname author_patreon_flair author_premium awarders body can_gild can_mod_post collapsed
collapsed_because_crowd_control collapsed_reason collapsed_reason_code comment_type controversiality created_utc
distinguished downs editable edited gilded gildings id is_submitter link_id locked media_metadata name no_follow
parent_id permalink removal_reason retrieved_on score score_hidden send_replies stickied subreddit subreddit_id
subreddit_name_prefixed subreddit_type top_awarded_type total_awards_received treatment_tags unrepliable_reason ups
""".split()
RS = """
adserver_click_url adserver_imp_pixel all_awardings allow_live_comments app_store_data approved approved_by archived
author author_cakeday author_created_utc author_flair_background_color author_flair_css_class author_flair_richtext
author_flair_template_id author_flair_text author_flair_text_color author_flair_type author_fullname author_id
author_patreon_flair author_premium awarders banned_by brand_safe call_to_action can_gild can_mod_post category clicked
collections content_categories contest_mode created created_utc crosspost_parent crosspost_parent_list discussion_type
distinguished domain domain_override downs edited embed_type embed_url event_end event_is_live event_start events
eventsOnRender gallery_data gilded gildings hidden hide_score href_url id ignore_reports impression_id impression_id_str
is_blank is_created_from_ads_ui is_crosspostable is_gallery is_meta is_original_content is_reddit_media_domain
is_robot_indexable is_self is_survey_ad is_video likes link_flair_background_color link_flair_css_class
link_flair_richtext link_flair_template_id link_flair_text link_flair_text_color link_flair_type locked media
media_embed media_metadata media_only mobile_ad_url mod_reports name no_follow num_comments num_crossposts num_reports
original_link outbound_link over_18 parent_whitelist_status permalink pinned poll_data post_hint preview priority_id
promo_layout promoted promoted_by promoted_display_name promoted_url pwls quarantine removal_reason removed removed_by
removed_by_category report_reasons retrieved_on rte_mode saved score secure_media secure_media_embed selftext
send_replies show_media sk_ad_network_data spam spoiler stickied subreddit subreddit_id subreddit_name_prefixed
subreddit_subscribers subreddit_type suggested_sort third_party_trackers third_party_tracking third_party_tracking_2
thumbnail thumbnail_height thumbnail_width title top_awarded_type total_awards_received treatment_tags ups upvote_ratio
url url_overridden_by_dest user_reports view_count whitelist_status wls
""".split()

# Columns with a type of their own; ``edited`` is a flag or an epoch, all others are text.
BIGINT = """
score created_utc num_comments ups downs controversiality gilded total_awards_received retrieved_on retrieved_utc
author_created_utc created num_crossposts thumbnail_height thumbnail_width
""".split()
BOOLEAN = """
over_18 is_self is_video archived locked stickied spoiler quarantine pinned hidden saved can_gild can_mod_post
is_submitter send_replies no_follow is_crosspostable is_gallery is_meta is_original_content is_reddit_media_domain
is_robot_indexable is_survey_ad allow_live_comments promoted score_hidden
""".split()

# Fields kept however rarely they are used, the sort keys, and the least usage of other fields.
CORE = ["id", "author", "subreddit", "link_id", "parent_id", "created_utc"]
SORT_KEYS = ["author", "subreddit", "created_utc"]
USAGE = 0.1

# Types by their names in the usage statistics, and SQL names of flat types; all others are text.
SCALARS = {"int": "bigint", "float": "double", "bool": "boolean"}
SQL_NAMES = {"bigint": "BIGINT", "int64": "BIGINT", "int": "BIGINT", "int32": "BIGINT", "double": "DOUBLE", "float": "DOUBLE", "boolean": "BOOLEAN", "bool": "BOOLEAN"}
NESTED = r"^(struct|array|list|map|variant)"

EXTRA = "extra_json"
MASTER = {"rc": RC, "rs": RS}


def column_type(name: str) -> T.DataType:
    """The type of a master column."""
    if name == "edited" or name in BIGINT:
        return T.LongType()
    return T.BooleanType() if name in BOOLEAN else T.StringType()


def master_schema(kind: str) -> T.StructType:
    """The schema every table of a kind has: its columns in order, then the overflow."""
    return T.StructType([T.StructField(c, column_type(c)) for c in MASTER[kind]] + [T.StructField(EXTRA, T.StringType())])


def kept_fields(usage: DataFrame, least: float = USAGE) -> DataFrame:
    """Of rows (field, rank, type, usage) the first type of each field that is used enough or a core field.

    usage is a number as text or ``always``; ties of rank go to the least type; null or unreadable usage counts as 0.
    """
    share = F.when(F.col("usage") == "always", 1.0).otherwise(F.coalesce(F.expr("try_cast(usage AS double)"), F.lit(0.0)))
    best = usage.groupBy("field").agg(F.min_by(F.struct("type", share.alias("share")), F.struct("rank", "type")).alias("b"))
    return best.select("field", "b.type", "b.share").filter((F.col("share") >= least) | F.col("field").isin(CORE))


def _among(names: dict[str, str], x: Column, other: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for pair in names.items() for v in pair]), x), F.lit(other))


def shapes(types: DataFrame) -> DataFrame:
    """path and ddl of rows (path, type): the Spark type of every place that the usage statistics describe.

    path is an array of steps, ``[]`` standing for an array's elements. A place takes its shape from the places one step
    below it, so one grouping per level, from the deepest up, makes all types: objects become structs with their fields by
    name, arrays take the type of their elements. Objects and arrays without a described inside are text and lists of
    text; unknown names, key-value objects and null are text, so that no column has a type that only nulls have.
    """
    flat = types.select("path", F.size("path").alias("n"), "type", _among(SCALARS, F.col("type"), "string").alias("ddl"))
    done, depth = None, flat.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    for n in range(depth, 0, -1):
        level = flat.filter(F.col("n") == n)
        if done is not None:
            step = F.element_at("path", -1)
            field = F.struct(step.alias("step"), F.concat(F.lit("`"), F.replace(step, F.lit("`"), F.lit("``")), F.lit("`:"), F.col("ddl")).alias("text"))
            inside = done.filter(F.size("path") == n + 1).groupBy(F.slice("path", 1, n).alias("path")).agg(F.min(F.when(step == "[]", F.col("ddl"))).alias("element"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(step != "[]", field))), lambda f: f.text), ",").alias("fields"))
            level = level.join(inside, "path", "left")
        else:
            level = level.withColumns({"element": F.lit(None).cast("string"), "fields": F.lit("")})
        held = F.when(F.col("type") == "array", F.concat(F.lit("array<"), F.coalesce("element", F.lit("string")), F.lit(">"))).when((F.col("type") == "object") & (F.col("fields") != ""), F.concat(F.lit("struct<"), "fields", F.lit(">"))).otherwise(F.col("ddl"))
        level = level.select("path", held.alias("ddl"))
        done = level if done is None else done.unionByName(level)
    return flat.select("path", "ddl").limit(0) if done is None else done


def declared_schema(usage: DataFrame, types: DataFrame, least: float = USAGE) -> T.StructType:
    """The schema of kept fields (see :func:`kept_fields`) of described types (see :func:`shapes`), by name, and the overflow.

    ``edited`` is a bigint whatever is stated. A schema is small: its fields are collected.
    """
    top = shapes(types).filter("size(path) = 1").select(F.col("path")[0].alias("field"), "ddl")
    rows = kept_fields(usage, least).select("field").join(top, "field", "left").orderBy("field").collect()
    kinds = [(r["field"], "bigint" if r["field"] == "edited" else r["ddl"] or "string") for r in rows]
    return T.StructType([T.StructField(name, T.DataType.fromDDL(ddl)) for name, ddl in kinds] + [T.StructField(EXTRA, T.StringType())])


def sql_name(kind: Column) -> Column:
    """The SQL name of a Spark or Arrow type's name: JSON for nested types, VARCHAR for all that isn't a number or a flag."""
    return F.when(kind.rlike(NESTED), "JSON").otherwise(_among(SQL_NAMES, kind, "VARCHAR"))


def is_simple(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType))


def keep_simple(df: DataFrame) -> DataFrame:
    """Drops columns of nested types."""
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema if is_simple(f.dataType)])
