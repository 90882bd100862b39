"""One query per operator, on the driver's tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import tables as t
from tidemark.functions import dates, keys, measures, text, titles
from tidemark.operators import (
    attributes, changes, dims, hierarchy, history, labels, names, quality, scd2, sessions,
    snapshots, staging, summary,
)
from tidemark.plans.directory import name_tables, stage_history, update_intervals
from tidemark.plans.directory import person_dim as build_person_dim
from tidemark.plans.directory import snapshot_tables as build_snapshot_tables
from tidemark.plans.report import report_tables
from tidemark.plans.role_history import role_history as build_role_history
from tidemark.plans.standardised import change_facts as build_change_facts
from tidemark.plans.standardised import private_contacts as build_private_contacts
from tidemark.session import materialise
from tidemark.sources import intervals as interval_source
from tidemark.sources import pages as page_source
from tidemark.sources import tables as table_source

QUERIES = {}

OBSERVED = changes.Observed("entity", "name", "position", "unit", "grp", "observed")
CONTACT = changes.Observed("contact", "name", "position", "unit", "grp", "observed")
BASELINE = dt.date(1995, 6, 30)
MOVES = {dt.date(1995, 6, 29): dt.date(1995, 6, 30)}
PLACEHOLDERS = {"position": ["5-LOW", "-", "--"], "grp": ["", "."]}
USER_GAP, GLOBAL_GAP = 0.7, 1200 / 86400

VOCABULARY = {"warm": ["red", "hot"], "cool": ["blue", "cold"]}
NAME_START = [(r"^(small|old)[\s\.]", "warm"), (r"^(large)[\s\.]", "cool")]
NAME_TOKENS = [(r"(?:^|\s)(?:ring|bolt)(?:\s|$)", "warm"), (r"(?:^|\s)(?:plate|rod)(?:\s|$)", "cool")]

# Rules of the cascade: label, kind, pattern.
RULES = [
    ("A", "phrase", "mr red"), ("A", "phrase", "(ret) old"), ("A", "phrase", "pk,"),
    ("A", "start", "assoc"), ("A", "start", "adj a/prof."),
    ("A", "end", "ear"), ("A", "name", "hot"), ("A", "name", "x"),
    ("B", "phrase", "cold ring"), ("B", "word", "widget"), ("B", "start", "justice"),
    ("C", "word", "blue"), ("C", "word", "bolt"), ("C", "word", "bbm"),
    ("D", "word", "gizmo"), ("D", "word", "small"),
]
STEPS = [
    labels.Step("A", "phrase", "phrase"),
    labels.Step("A", "start", "start_mixed"),
    labels.Step("A", "end", "end_mixed"),
    labels.Step("A", "name", "word_mixed"),
    labels.Step("B", "phrase", "phrase"),
    labels.Step("B", "word", "capital_word"),
    labels.Step("B", "word", "first_or_last_word"),
    labels.Step("B", "start", "start"),
    labels.Step("C", "word", "capital_word"),
    labels.Step("C", "word", "first_word"),
    labels.Step("C", "word", "last_word"),
    labels.Step("C", "word", "any_word"),
    labels.Step("B", "word", "any_word"),
    labels.Step("D", "word", "first_or_last_word"),
]


def query(build):
    QUERIES[build.__name__] = build
    return build


def plain(df: DataFrame) -> DataFrame:
    """Dates, times and arrays as text, so that both engines show them alike."""
    shown = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col, "|")
        shown.append(col.alias(field.name))
    return df.select(*shown)


# Ingest and snapshots


@query
def snapshot_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = t.load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return plain(snapshots.stamp_snapshot(people, "REGISTER", dt.datetime(2024, 6, 1, 8, 30)))


@query
def append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = t.scratch_path(spark)
    people = t.load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    for day, group in ((1, "FIRST"), (8, "SECOND"), (1, "FIRST")):  # a load repeated changes nothing
        load = snapshots.stamp_snapshot(people, group, dt.datetime(2024, 6, day, 8, 30))
        table_source.append_table(load, path)
    stored = table_source.read_table(spark, path)
    return plain(
        stored.groupBy("snapshot_date", "group_name", "c_mktsegment").agg(
            F.count(F.lit(1)).alias("num_rows"), F.sum("c_custkey").alias("key_sum")
        )
    )


@query
def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = t.scratch_path(spark)
    table_source.replace_table(t.load(spark, sf_dir, "supplier"), path)
    content = table_source.read_current(spark, path)
    table_source.replace_table(content.withColumn("s_acctbal", -F.col("s_acctbal")), path)
    return table_source.read_current(spark, path)


@query
def load_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.load(spark, sf_dir, "events").select(
        F.col("event_type").alias("group_name"),
        F.to_date("ts").cast("timestamp_ntz").alias("_accessed_at"), "value",
    )
    durations = events.groupBy("group_name", "_accessed_at").agg(
        F.max("value").alias("extraction_duration_seconds")
    )
    orders = t.load(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("group_name"), F.col("o_orderdate").alias("_accessed_at")
    )
    loads = {"events": events, "orders": orders}
    return plain(snapshots.load_manifest(loads, durations=durations))


@query
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_source.extract_page_records(
        t.load(spark, sf_dir, "pages"), keep=["page_id", "url"], sections=["nav"],
        fields={"label": "a", "target": "a@href", "note": ".note"}, required=["label", "target"],
    )


@query
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_source.extract_page_links(
        t.load(spark, sf_dir, "pages"), parent="url", sections=["nav"], listing="ul"
    )


@query
def snapshot_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People, units and manifest of one load from all pages, each the root of its own links."""
    pages = t.load(spark, sf_dir, "pages").select("url", "html")
    made = build_snapshot_tables(
        pages, pages.select(F.col("url").alias("link")), "REGISTER", dt.datetime(2024, 6, 1, 8, 30), 2.5,
        lists={"sections": ["nav"], "listing": "ul"},
        records={
            "sections": ["nav"], "fields": {"position": "a", "name": "a@href", "email": ".note"},
            "required": ["position", "name"],
        },
    )
    columns = {
        "names": ("department", "name", "url", "position", F.lit(None).cast("long")),
        "departments": ("parent_name", "department_name", "department_link", "children", F.lit(None).cast("long")),
        "metadata": ("group_name", "table_name", F.lit(None).cast("string"), F.col("extraction_duration_seconds").cast("string"), "num_rows"),
    }
    parts = [
        made[part].select(
            F.lit(part).alias("part"), "group_name", "_accessed_at",
            *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in zip(("unit", "name", "link", "detail", "num_rows"), cols, strict=True)],
        )
        for part, cols in columns.items()
    ]
    return plain(reduce(DataFrame.unionByName, parts))


@query
def hierarchy_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = t.nodes(spark, sf_dir)
    roots = tree.filter(F.col("parent").isNull()).select("key")
    edges = tree.filter(F.col("parent").isNotNull())
    return plain(hierarchy.walk_hierarchy(edges, roots, "parent", "key", "ordinal", ["name"]))


@query
def hierarchy_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.flatten_hierarchy(t.nodes(spark, sf_dir))


# Validity intervals


@query
def content_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.assignments(spark, sf_dir)
    position = F.nullif("position", F.lit("5-LOW"))
    return rows.select(
        "seq", keys.content_key("entity", position, "unit", "grp").alias("content_key")
    )


@query
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.monthly(spark, sf_dir)
    return plain(snapshots.latest_snapshot(rows, ["name", "position", "unit", "grp"], "month"))


@query
def last_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(scd2.last_seen(t.assignments(spark, sf_dir), "grp", "observed"))


CONTENT = ["name", "position", "unit", "grp"]


def _stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The raw table, and the intervals up to its last month but one, a row per year."""
    raw = materialise(t.monthly(spark, sf_dir))
    last = raw.agg(F.max("month").alias("m")).scalar()
    existing = (
        raw.filter(F.col("month") < last)
        .groupBy(
            keys.content_key(*CONTENT).alias("content"), *CONTENT, F.year("month").alias("y")
        )
        .agg(F.min("month").alias("_valid_from"), F.max("month").alias("_valid_to"))
        .drop("y")
    )
    return raw, materialise(existing)


@query
def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, existing = _stored(spark, sf_dir)
    latest = snapshots.latest_snapshot(raw, CONTENT, "month")
    current = latest.withColumn("content", keys.content_key(*CONTENT))
    return plain(scd2.scd2_merge(existing, current, "content", CONTENT, "grp", pass_closed=False))


@query
def scd2_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, existing = _stored(spark, sf_dir)
    return plain(update_intervals(raw, existing, CONTENT, "grp", "content", "month"))


@query
def scd2_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same update on a stored table in open and closed parts, the load merged twice."""
    raw, existing = _stored(spark, sf_dir)
    path = t.scratch_path(spark)
    interval_source.store_intervals(existing, path, "grp")
    current = snapshots.latest_snapshot(raw, CONTENT, "month").withColumn("content", keys.content_key(*CONTENT))
    for _ in range(2):
        interval_source.merge_into(path, current, "content", CONTENT, "grp")
    return plain(interval_source.read_intervals(spark, path))


# Names


@query
def leading_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.titled(spark, sf_dir).select("seq", titles.leading_title("raw").alias("title"))


@query
def trailing_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.titled(spark, sf_dir).select("seq", titles.trailing_suffix("raw").alias("suffix"))


@query
def strip_affixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.split_names(t.titled(spark, sf_dir), "raw").select("seq", "extracted_name")


@query
def name_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = names.split_names(t.titled(spark, sf_dir), "raw")
    return names.build_name_mapping(named, ["extracted_name", "raw", "entity"])


@query
def attribute_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = names.split_names(t.titled(spark, sf_dir), "raw")
    columns = ["entity", "extracted_name", "prefix"]
    return plain(names.attribute_history(named, columns, "observed", "observed"))


@query
def name_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.titled(spark, sf_dir).select(
        F.col("raw").alias("name"), F.upper("position").alias("email"),
        F.col("observed").alias("_valid_from"), F.col("observed").alias("_valid_to"),
    )
    made = name_tables(rows)
    mapping = made["names_mapping"].select(
        F.lit("names_mapping").alias("part"), "email", "extracted_name", F.col("name").alias("value"),
        *[F.lit(None).cast("date").alias(c) for c in ("effective_from", "effective_to")],
    )
    histories = [
        made[part].select(F.lit(part).alias("part"), "email", "extracted_name", F.col(value).alias("value"), "effective_from", "effective_to")
        for part, value in (("prefixes_history", "prefix"), ("postfixes_history", "postfix"))
    ]
    return plain(reduce(DataFrame.unionByName, histories, mapping))


@query
def canonicalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.assignments(spark, sf_dir)
    pairs = t.mapping(spark, sf_dir)
    both = names.canonicalise(rows, pairs, "name", "raw", "cleaned", "canonical")
    both = names.canonicalise(both, pairs, "name", "raw", "cleaned", "mapped", fallback=False)
    both = names.canonicalise(
        both, pairs, "name", "raw", "cleaned", "mapped_or_raw", empty_is_missing=False
    )
    return both.select("seq", "name", "canonical", "mapped", "mapped_or_raw")


# Staging and flags


@query
def stage_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {"o_orderkey": "id", "o_orderstatus": "group_name", "o_orderdate": "_accessed_at"}
    staging.project_rename(t.load(spark, sf_dir, "orders"), spec, view="stage_orders")
    return plain(spark.table("stage_orders"))


@query
def flag_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.assignments(spark, sf_dir)
    rows = staging.flag_latest(rows, "observed", ["grp"])
    rows = staging.flag_latest(rows, "observed", ["entity", "unit"], "is_latest_in_unit", False)
    return rows.select("seq", "is_latest", "is_latest_in_unit")


@query
def remap_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t.load(spark, sf_dir, "orders")
    return plain(
        orders.select("o_orderkey", dates.remap_dates("o_orderdate", MOVES).alias("observed"))
    )


@query
def keep_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.assignments(spark, sf_dir).select("entity", "unit", "name")
    return staging.keep_longest(rows, ["entity", "unit"], "name")


@query
def drop_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.assignments(spark, sf_dir).withColumn("grp", F.nullif("grp", F.lit("P")))
    return staging.drop_sentinels(rows, PLACEHOLDERS).select("seq", "position", "grp")


# Entity attributes


@query
def shared_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attributes.shared_values(t.shared_parts(spark, sf_dir), "entity", "value")


@query
def latest_private_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.shared_parts(spark, sf_dir)
    return plain(attributes.latest_private_value(rows, "entity", "value", "observed"))


@query
def possible_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(attributes.possible_duplicates(t.shared_parts(spark, sf_dir), "entity", "value"))


@query
def possible_triplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.shared_parts(spark, sf_dir)
    return plain(attributes.possible_duplicates(rows, "entity", "value", n=3))


@query
def layered_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    past = staging.flag_latest(
        t.title_history(spark, sf_dir), "effective_to", ["entity"], few_groups=False
    )
    people = t.assignments(spark, sf_dir).groupBy("entity").agg(F.max("name").alias("name"))
    return labels.layered_label(
        people, "entity",
        [
            ("current_title", labels.current_label(past, "entity", "title", VOCABULARY)),
            ("historical_title", labels.historical_label(past, "entity", "title", VOCABULARY)),
            ("name_start", labels.label_of_pattern("name", NAME_START)),
            ("name_token", labels.label_of_pattern("name", NAME_TOKENS)),
        ],
    )


@query
def strip_leading_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.titled(spark, sf_dir)
    return rows.select("seq", titles.strip_leading_titles("raw").alias("stripped"))


@query
def token_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = text.token_features("text")
    features["words_length"] = F.length(F.array_join(features.pop("all_words"), ""))
    return t.load(spark, sf_dir, "documents").select(
        "doc_id", *[c.alias(name) for name, c in features.items()]
    )


@query
def rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "label string, kind string, pattern string")
    people = t.titled(spark, sf_dir).select(F.trim("raw").alias("text")).distinct()
    return labels.rule_cascade(people, "text", rules, STEPS, "Unknown")


@query
def entity_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_entity_dim(spark, sf_dir))


def _entity_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = t.shared_parts(spark, sf_dir)
    private = attributes.latest_private_value(people, "entity", "value", "observed")
    segment = t.load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    customers = segment.select("entity")
    return dims.entity_dim(
        customers, "entity", [private.drop("observed"), segment],
        defaults={"has_private_value": False},
    )


def _staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = t.titled(spark, sf_dir).select(
        F.upper("name").alias("person"), F.col("raw").alias("name"), F.col("unit").alias("email"),
        F.col("observed").alias("_valid_from"), F.col("observed").alias("_valid_to"),
    )
    found = names.split_names(rows)
    return {
        value: stage_history(
            names.attribute_history(found, ["email", "person", value]), "person", value, MOVES
        )
        for value in ("prefix", "postfix")
    }


@query
def staged_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        df.withColumnRenamed(value, "value").withColumn("part", F.lit(value))
        for value, df in _staged(spark, sf_dir).items()
    ]
    return plain(reduce(DataFrame.unionByName, parts))


@query
def person_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.contacts(spark, sf_dir).select(
        F.upper("name").alias("person"), F.concat("unit", "position", "grp").alias("contact"), "observed"
    )
    private = attributes.latest_private_value(rows, "person", "contact", "observed")
    return build_person_dim(
        rows, "person", _staged(spark, sf_dir), private.drop("observed")
    )


@query
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.assignments(spark, sf_dir)
    position = F.nullif("position", F.lit("5-LOW"))
    return rows.select(
        "seq", keys.surrogate_key("entity", position, "unit", "seq").alias("assignment_key")
    )


@query
def unit_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.assignments(spark, sf_dir).withColumn("position", F.nullif("position", F.lit("5-LOW")))
    return plain(dims.unit_dim(rows, "name", "position", "grp", "unit", "observed"))


# History and changes


def _events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("day")
    )


@query
def stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events_by_day(spark, sf_dir)
    return plain(history.stints(rows, "user_id", ["event_type"], "day", gap_days=5))


@query
def stints_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.assignments(spark, sf_dir).withColumn("unit", F.nullif("unit", F.lit("PROMO")))
    return plain(
        history.stints(rows, "name", ["unit"], "observed", gap_days=30, carry=["position", "grp"])
    )


@query
def flag_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events_by_day(spark, sf_dir)
    held = history.stints(rows, "user_id", ["event_type"], "day", gap_days=5)
    return plain(history.flag_current(held, "user_id"))


def _role_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = t.mapping(spark, sf_dir)
    dim = dims.entity_dim(pairs, "cleaned")
    return build_role_history(
        t.assignments(spark, sf_dir), pairs, dim, OBSERVED, "raw", "cleaned", "cleaned",
        "entity_key", gap_days=200, date_moves=MOVES,
        placeholders={"name": ("", "-", "--", "old rod"), "entity": ("-",)},
    )


@query
def role_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_role_history(spark, sf_dir))


@query
def current_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(history.current_roles(_role_history(spark, sf_dir)))


@query
def generic_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.generic_values(t.contacts(spark, sf_dir), "contact")


@query
def single_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.contacts(spark, sf_dir)
    return changes.single_position_entities(rows, CONTACT, changes.GENERIC_CONTACTS)


@query
def with_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(changes.with_previous(t.contacts(spark, sf_dir), CONTACT))


@query
def with_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(changes.with_next(t.contacts(spark, sf_dir), CONTACT))


def _changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.contacts(spark, sf_dir)
    return changes.changed_rows(changes.with_previous(rows, CONTACT), CONTACT, BASELINE)


@query
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_changed(spark, sf_dir))


@query
def new_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(changes.new_entities(_changed(spark, sf_dir), CONTACT))


@query
def shares_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = changes.with_previous(t.contacts(spark, sf_dir), CONTACT)
    return plain(
        pairs.select(
            "contact", "observed", "name", "lag_name", "position", "unit", "grp",
            text.shares_word("lag_name", "name").alias("alike"),
        )
    )


@query
def renames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(changes.renames(_changed(spark, sf_dir), CONTACT))


@query
def reassignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(changes.reassignments(_changed(spark, sf_dir), CONTACT))


@query
def group_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(changes.group_changes(_changed(spark, sf_dir), CONTACT))


@query
def unit_change_new_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(changes.unit_changes(_changed(spark, sf_dir), CONTACT, same_role=False))


@query
def unit_change_same_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(changes.unit_changes(_changed(spark, sf_dir), CONTACT, same_role=True))


@query
def role_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(changes.role_changes(_changed(spark, sf_dir), CONTACT))


@query
def disappearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.contacts(spark, sf_dir)
    return plain(changes.disappearances(changes.with_next(rows, CONTACT), CONTACT, rows))


@query
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(changes.change_feed(t.contacts(spark, sf_dir), CONTACT, BASELINE))


@query
def change_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        build_change_facts(
            t.contacts(spark, sf_dir), t.mapping(spark, sf_dir), CONTACT, "raw", "cleaned", BASELINE, MOVES,
            placeholders={"name": ("", "-", "--", "old rod"), "contact": ("-",)},
        )
    )


@query
def private_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = t.contacts(spark, sf_dir).withColumn("contact", F.concat("contact", F.col("seq") % 7))
    return plain(
        build_private_contacts(seen, t.mapping(spark, sf_dir), "name", "contact", "observed", "raw", "cleaned")
    )


@query
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of the report in one long form: part, group, item, value."""
    people = t.load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    facts = _orders(spark, sf_dir).select("o_custkey", "priority")
    made = report_tables(
        facts, people, "o_custkey", "priority", {"segment": SEGMENTS},
        {"Has Segment": F.col("segment").isNotNull()}, RENAMED, ["2-HIGH"],
    )
    parts = []
    for name, df in made.items():
        keys = [c for c, kind in df.dtypes if kind == "string" and c != "band"]
        group = F.col(keys[0]) if keys else F.lit(None).cast("string")
        for c in df.columns:
            if c not in keys and c != "band":
                parts.append(df.select(
                    F.lit(name).alias("part"), group.alias("grp"), F.lit(c).alias("item"), F.col(c).cast("double").alias("value"),
                    (F.col("band") if c == "pct" and "band" in df.columns else F.lit(None).cast("string")).alias("band"),
                ))
    return reduce(DataFrame.unionByName, parts)


# Load sessions


@query
def gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.load(spark, sf_dir, "events")
    return plain(sessions.gap_sessions(events, "ts", USER_GAP, ["user_id"]))


def _global_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.load(spark, sf_dir, "events")
    return sessions.gap_sessions(events, "ts", GLOBAL_GAP, round_days=5)


@query
def gap_sessions_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_global_sessions(spark, sf_dir))


@query
def assign_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.load(spark, sf_dir, "events")
    found = sessions.gap_sessions(events, "ts", USER_GAP, ["user_id"])
    clicks = found.filter(F.col("session_id") > 1)
    rows = sessions.assign_session(events, clicks, "ts", ["user_id"])
    return rows.select("event_id", "session_id")


@query
def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = t.load(spark, sf_dir, "events").select(
        F.col("event_type").alias("table_name"),
        F.col("user_id").cast("string").alias("group_name"),
        F.length("props").cast("long").alias("num_rows"), F.col("ts").alias("_accessed_at"),
    )
    return plain(sessions.load_history(manifest, _global_sessions(spark, sf_dir)))


# Summaries and quality


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "orders").select(
        "o_custkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"), "o_orderstatus"
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_acctbal", "c_nationkey",
    )


RENAMED = {"1-URGENT": "2-HIGH"}
SEGMENTS = ["AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Unknown"]


@query
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.share_of_total(_orders(spark, sf_dir), "priority")


@query
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.category_counts(_customers(spark, sf_dir), "segment")


def _breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.breakdown(
        _orders(spark, sf_dir), _customers(spark, sf_dir), "o_custkey", "priority", "segment"
    )


@query
def breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _breakdown(spark, sf_dir)


@query
def headcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.headcount(_orders(spark, sf_dir), "o_custkey", "priority")


def _completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.completeness(
        _customers(spark, sf_dir),
        {
            "Has Segment": F.col("segment").isNotNull() & (F.col("segment") != "Unknown"),
            "In Credit": F.col("c_acctbal") > 0,
            "Low Nation": F.col("c_nationkey") < 7,
        },
    )


@query
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _completeness(spark, sf_dir)


@query
def rollup_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _breakdown(spark, sf_dir)
    return summary.rollup_renamed(counts, "priority", RENAMED, by=["segment"])


@query
def rollup_renamed_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _orders(spark, sf_dir).filter(F.col("priority").isNotNull())
    return summary.rollup_renamed(facts, "priority", RENAMED, entity="o_custkey")


def _pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.pivot_counts(
        _breakdown(spark, sf_dir), "priority", "segment", categories=SEGMENTS
    )


@query
def pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pivot(spark, sf_dir)


@query
def split_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    outside, inside = summary.split_by_membership(
        _orders(spark, sf_dir), "priority", ["1-URGENT", "2-HIGH"]
    )
    return outside.groupBy("priority").agg(F.count(F.lit(1)).alias("n"), F.lit("outside").alias("part")).unionByName(
        inside.groupBy("priority").agg(F.count(F.lit(1)).alias("n"), F.lit("inside").alias("part"))
    )


@query
def row_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = summary.row_percent(_pivot(spark, sf_dir), "priority")
    return shares.select("priority", *[F.round(c, 6).alias(c) for c in SEGMENTS])


@query
def band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _completeness(spark, sf_dir).withColumn("band", measures.band("pct"))


@query
def sample_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = t.load(spark, sf_dir, "customer").withColumn(
        "label", F.when(F.col("c_mktsegment") == "BUILDING", "Unknown").otherwise("Known")
    )
    placeholders = ["-", "--", "Customer#000000007"]
    return summary.sample_unlabelled(people, "c_name", "label", placeholders=placeholders)


@query
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return quality.run_checks(
        orders,
        [
            quality.Check("o_custkey", unique=True, not_null=True),
            quality.Check("priority", not_null=True, accepted=["1-URGENT", "2-HIGH"]),
            quality.Check(
                "o_orderstatus", unique=True, accepted=["F", "P"],
                where=F.col("priority").isNotNull(),
            ),
        ],
    )
