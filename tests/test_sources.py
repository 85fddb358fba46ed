import json

from cases import APP_ROWS, EVENT_ROWS, PAM_ROWS, SESSION_ROWS, bag, event, frame, world

from kinbridge.contracts import SOURCE_COLUMNS
from kinbridge.plans.star import plan_star
from kinbridge.plans.validation import label_events
from kinbridge.sources import replay, sources_from_folder, sources_from_manifest
from kinbridge.sources.manifest import TenantEntry, fee_limits, read_manifest, read_source

ROWS = dict(
    pam_customers=PAM_ROWS, app_customers=APP_ROWS,
    activity_events=EVENT_ROWS, customer_sessions=SESSION_ROWS,
)


def write_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def write_sources(spark, folder, renames=None):
    for name, rows in ROWS.items():
        names = (renames or {}).get(name, {})
        lines = [
            json.dumps({names.get(k, k): v for k, v in r.items() if v is not None}) for r in rows
        ]
        write_lines(spark, f"{folder}/{name}.json", lines)


def test_folder_of_ndjson(spark, folder):
    write_sources(spark, folder)
    from_files, literal = plan_star(sources_from_folder(spark, folder)), plan_star(world(spark))
    assert bag(from_files.activity) == bag(literal.activity)
    assert bag(from_files.dim_customer) == bag(literal.dim_customer)


def test_manifest_with_two_layouts(spark, folder):
    own = {"activity_events": {"app_customer_id": "player", "platform_fee_usdt": "fee"}}
    write_sources(spark, f"{folder}/a")
    write_sources(spark, f"{folder}/b", own)
    paths = lambda d: {n: f"{folder}/{d}/{n}.json" for n in SOURCE_COLUMNS}
    lines = [
        json.dumps({"tenant": "t1", "paths": paths("a"), "max_platform_fee": "0.4"}),
        json.dumps({"tenant": "t2", "paths": paths("b"), "renames": own}),
    ]
    write_lines(spark, f"{folder}/manifest", lines)
    entries = read_manifest(spark, f"{folder}/manifest")
    assert entries[1].layout("activity_events")[1] == "player"
    sources = sources_from_manifest(spark, entries)
    assert sources.activity_events.count() == 2 * len(EVENT_ROWS)
    events = sources.activity_events.drop("_corrupt_record")
    assert bag(events.distinct()) == bag(world(spark).activity_events.distinct())
    limits = fee_limits(spark, entries).collect()
    assert [(r.tenant, str(r.max_platform_fee)) for r in limits] == [("t1", "0.400000000000000000")]


def test_tenants_of_one_layout_share_a_scan(spark, folder):
    for d in "ab":
        write_sources(spark, f"{folder}/{d}")
    entries = [
        TenantEntry(d, {n: f"{folder}/{d}/{n}.json" for n in SOURCE_COLUMNS}) for d in "ab"
    ]
    events = sources_from_manifest(spark, entries).activity_events
    assert events._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_replay_counts_non_blank_lines(spark, folder):
    write_lines(spark, f"{folder}/in/activity_events.json", ['{"a":1}', "", "  ", ' {"a":2}\t'])
    write_lines(spark, f"{folder}/in/pam_customers.json", ["{}"])
    found = replay.messages(spark, f"{folder}/in")
    assert {(r.topic, r.value) for r in found.collect()} == {
        ("activity_events", '{"a":1}'), ("activity_events", '{"a":2}'), ("pam_customers", "{}"),
    }
    replay.publish_to_folder(found, f"{folder}/topics")
    published = spark.read.schema("value string, topic string").text(f"{folder}/topics")
    counts = {r.topic: r.messages for r in replay.topic_counts(published).collect()}
    assert counts == {"activity_events": 2, "pam_customers": 1, None: 3}


def test_labels_ignore_unknown_columns_of_files(spark, folder):
    row = event("E", "A") | {"extra": "x"}
    write_lines(spark, f"{folder}/e", [json.dumps(row)])
    from kinbridge.sources import read_ndjson

    raw = read_ndjson(spark, f"{folder}/e", "activity_events")
    assert label_events(raw).first().rejection_reason is None
    assert frame(spark, "activity_events", [row]).count() == 1


def test_manifest_keeps_lines_that_are_not_json(spark, folder):
    write_lines(spark, f"{folder}/a", ['{"event_id": "E1"}', "{broken"])
    lines = [json.dumps({"tenant": "t", "paths": {"activity_events": f"{folder}/a"}})]
    write_lines(spark, f"{folder}/manifest", lines)
    entries = read_manifest(spark, f"{folder}/manifest")
    found = read_source(spark, "activity_events", entries).collect()
    assert {(r.event_id, r._corrupt_record) for r in found} == {("E1", None), (None, "{broken")}


def test_topics_of_a_folder_with_a_space(spark, folder):
    write_lines(spark, f"{folder}/a b/some+topic.json", ["one", "two"])
    found = replay.messages(spark, f"{folder}/a b").collect()
    assert sorted((r.topic, r.value) for r in found) == [
        ("some+topic", "one"), ("some+topic", "two"),
    ]
