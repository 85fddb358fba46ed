"""Loads in any order: survivors, identities, places and the key index."""

from datetime import date, datetime

import pytest
from cases import APP_ROWS, EVENT_ROWS, PAM_ROWS, app, bag, event, frame, pam, person_id, session, world
from pyspark.sql import functions as F

from kinbridge import workspace
from kinbridge.contracts import BRIDGE, DIM_CUSTOMER, FACT_ACTIVITY, FACT_SESSION, WAREHOUSE
from kinbridge.functions import full_text, short_text
from kinbridge.plans import facts, validation
from kinbridge.plans.run import QUARANTINE, run
from kinbridge.plans.validation import RANK
from kinbridge.sinks import keys, merge, quarantine, warehouse

#: As the session of the tests says.
BUCKETS = 8
FIRST, SECOND, THIRD = (datetime(2026, 2, d) for d in (1, 2, 3))


def tables(spark, root):
    return {
        name: bag(warehouse.read_current(spark, root, c).drop(c.version))
        for name, c in WAREHOUSE.items()
    }


REPEATS = [
    event("E1", "A1", "2026-01-10T10:00:00Z", fee="2"),
    event("E1", "A1", "2026-01-10T09:00:00Z", fee="1"),
    event("E1", "A1", "2026-02-10T09:00:00Z", fee="0"),
]
LOGINS = [session("S1", "P1", login=f"2026-01-1{d}T09:00:00Z", logout="2026-01-20T09:00:00Z") for d in (1, 2)]


@pytest.mark.parametrize("order", [(0, 1, 2), (1, 2, 0), (2, 0, 1), (2, 1, 0)])
def test_the_same_fact_survives_in_any_order(spark, folder, order):
    """Also with one load time, or falling ones, and across months."""
    for i, n in enumerate(order):
        stamp = (FIRST, FIRST, SECOND)[n]
        logins = LOGINS[n : n + 1]
        run(spark, world(spark, events=[REPEATS[n]], sessions=logins), folder, loaded_at=stamp)
    (row,) = warehouse.read_current(spark, folder, FACT_ACTIVITY).collect()
    assert (row.event_time, row.platform_fee_usdt) == (datetime(2026, 1, 10, 9), 1)
    (login,) = warehouse.read_current(spark, folder, FACT_SESSION).collect()
    assert login.session_date == date(2026, 1, 11)
    # Every month by itself gives the same rows.
    for month, count in (("202601", 1), ("202602", 0)):
        part = warehouse.read_current(spark, folder, FACT_ACTIVITY, months=[month])
        assert part.count() == count


def test_a_better_repeat_without_customer_withdraws_the_fact(spark, folder):
    good = event("E1", "A1", "2026-01-10T10:00:00Z")
    better = event("E1", "A1", "2026-01-10T09:00:00Z", tenant="nowhere")
    # Alone, the account's email would be unknown in that tenant; so it is held back.
    blocked = [r for r in APP_ROWS if r["app_customer_id"] != "A1"]
    for rows in ([good, better], [better, good]):
        root = f"{folder}/{rows[0]['tenant']}"
        for stamp, row in zip((FIRST, SECOND), rows):
            apps = blocked if row is better and rows[0] is better else APP_ROWS
            run(spark, world(spark, events=[row], sessions=[], apps=apps), root, loaded_at=stamp)
        whole = f"{root}-whole"
        run(spark, world(spark, events=rows, sessions=[]), whole, loaded_at=FIRST)
        assert tables(spark, root)["fact_activity_event"] == tables(spark, whole)["fact_activity_event"]


def test_corrected_email_moves_facts_and_customers(spark, folder):
    wrong = [app("A2", "bo2", "wrong") if r["app_customer_id"] == "A2" else r for r in APP_ROWS]
    wrong_pams = [pam("P3", "t2", "Cy", "cy") if r["pam_customer_id"] == "P3" else r for r in PAM_ROWS]
    run(spark, world(spark, apps=wrong, pams=wrong_pams), f"{folder}/parts", loaded_at=FIRST)
    before = warehouse.read_current(spark, f"{folder}/parts", DIM_CUSTOMER)
    assert person_id("t1", "wrong") in {r.canonical_customer_id for r in before.collect()}
    run(spark, world(spark, events=[], sessions=[]), f"{folder}/parts", loaded_at=FIRST)
    run(spark, world(spark), f"{folder}/whole", loaded_at=FIRST)
    assert tables(spark, f"{folder}/parts") == tables(spark, f"{folder}/whole")
    # And back again.
    run(spark, world(spark, events=[], sessions=[], apps=wrong, pams=wrong_pams), f"{folder}/parts", loaded_at=FIRST)
    run(spark, world(spark, apps=wrong, pams=wrong_pams), f"{folder}/wrong", loaded_at=FIRST)
    assert tables(spark, f"{folder}/parts") == tables(spark, f"{folder}/wrong")


def test_an_account_that_loses_its_email_loses_its_facts(spark, folder):
    run(spark, world(spark), f"{folder}/parts", loaded_at=FIRST)
    gone = [app("A1", "ada1", None) if r["app_customer_id"] == "A1" else r for r in APP_ROWS]
    run(spark, world(spark, events=[], sessions=[], apps=gone), f"{folder}/parts", loaded_at=SECOND)
    run(spark, world(spark, apps=gone), f"{folder}/whole", loaded_at=FIRST)
    assert tables(spark, f"{folder}/parts") == tables(spark, f"{folder}/whole")
    held = quarantine.read(spark, f"{folder}/parts/{QUARANTINE}", "unresolved_identity")
    assert held.count() == 2
    # The email comes back, and the facts with it.
    run(spark, world(spark, events=[], sessions=[]), f"{folder}/parts", loaded_at=THIRD)
    run(spark, world(spark), f"{folder}/known", loaded_at=FIRST)
    assert tables(spark, f"{folder}/parts") == tables(spark, f"{folder}/known")
    assert quarantine.read(spark, f"{folder}/parts/{QUARANTINE}", "unresolved_identity").count() == 0


def test_accounts_that_a_load_does_not_bring_keep_their_links(spark, folder):
    run(spark, world(spark), folder, loaded_at=FIRST)
    before = tables(spark, folder)
    run(spark, world(spark, events=[], sessions=[], apps=[], pams=[]), folder, loaded_at=SECOND)
    after = tables(spark, folder)
    assert after["bridge_customer_identity"] == before["bridge_customer_identity"]
    assert after["fact_activity_event"] == before["fact_activity_event"]


def test_held_rows_count_once_and_are_retired(spark, folder):
    ghosts = [event("E7", "A7"), event("E7", "A7"), event("X1", "A1", net="x")]
    for stamp in (FIRST, SECOND, THIRD):
        run(spark, world(spark, events=ghosts, sessions=[]), folder, loaded_at=stamp)
    path = f"{folder}/{QUARANTINE}"
    copies = {r.rejection_reason: r.copies for r in quarantine.read(spark, path).collect()}
    # Rejected rows are counted each time they come, facts without customer once.
    assert copies == {"unresolved_identity": 1, "invalid_net_result_usdt": 3}
    run(spark, world(spark, events=ghosts, sessions=[]), folder, loaded_at=THIRD)  # a retry
    copies = {r.rejection_reason: r.copies for r in quarantine.read(spark, path).collect()}
    assert copies == {"unresolved_identity": 1, "invalid_net_result_usdt": 3}
    known = world(
        spark, events=[], sessions=[], apps=[*APP_ROWS, app("A7", "gil", "gil")],
        pams=[*PAM_ROWS, pam("P7", "t1", "Gil", "gil")],
    )
    run(spark, known, folder, loaded_at=datetime(2026, 2, 4))
    states = {r.rejection_reason: r.state for r in quarantine.read_states(spark, path).collect()}
    assert states == {"unresolved_identity": "resolved", "invalid_net_result_usdt": "held"}
    assert warehouse.read_current(spark, folder, FACT_ACTIVITY).count() == 1
    quarantine.expire(spark, path, before=THIRD, at=datetime(2026, 2, 5))
    assert quarantine.read(spark, path).count() == 0
    # What was given up waits again when it comes again.
    run(spark, world(spark, events=ghosts, sessions=[]), folder, loaded_at=datetime(2026, 2, 6))
    assert [r.copies for r in quarantine.read(spark, path).collect()] == [4]


def test_copies_do_not_depend_on_the_split(spark, folder):
    bad = [event("X1", "A1", net="x")] * 4 + [event("X2", "A1", at=None)]
    run(spark, world(spark, events=bad), f"{folder}/whole", loaded_at=FIRST)
    for stamp, part in ((FIRST, bad[:1]), (SECOND, bad[1:3]), (THIRD, bad[3:])):
        run(spark, world(spark, events=part), f"{folder}/parts", loaded_at=stamp)
    got, want = (
        bag(quarantine.read(spark, f"{folder}/{p}/{QUARANTINE}").drop("rejected_at"))
        for p in ("parts", "whole")
    )
    assert got == want


def read_files(df):
    return {f.split("/bucket=")[1] for f in df.inputFiles()}


def test_a_small_batch_opens_only_its_buckets(spark, folder):
    many = [event(f"E{i}", "A1") for i in range(500)]
    run(spark, world(spark, events=many, sessions=[]), folder, loaded_at=FIRST)
    batch = spark.createDataFrame([("E3", "A1"), ("E4", "A1")], "event_id string, app_customer_id string")
    index = f"{warehouse.index_path(folder, FACT_ACTIVITY)}/of={BUCKETS}"
    assert len(workspace.children(spark, index)) == BUCKETS
    touched = {
        f"{r.b}" for r in batch.select(
            F.pmod(keys.key_hash(FACT_ACTIVITY), F.lit(BUCKETS)).alias("b")
        ).collect()
    }
    # Files of other buckets would break the lookup if they were opened.
    for name in workspace.children(spark, index):
        if name.removeprefix("bucket=") not in touched:
            spark.createDataFrame([("x",)], "v string").write.mode("append").text(f"{index}/{name}")
    found = keys.known(spark, folder, FACT_ACTIVITY, batch)
    assert {r.event_id for r in found.collect()} == {"E3", "E4"}
    plan = keys.read(spark, folder, FACT_ACTIVITY, batch)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(key_hash" in plan


def test_files_of_the_index_have_bloom_filters(spark, folder):
    run(spark, world(spark), folder, loaded_at=FIRST)
    index = f"{warehouse.index_path(folder, FACT_ACTIVITY)}/of={BUCKETS}"
    files = spark.read.parquet(index).inputFiles()
    assert files
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for file in files[:2]:
        place = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            jvm.org.apache.hadoop.fs.Path(file), conf
        )
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(place)
        columns = list(reader.getFooter().getBlocks().get(0).getColumns())
        filtered = {c.getPath().toDotString() for c in columns if c.getBloomFilterOffset() >= 0}
        reader.close()
        assert filtered == {"key_hash"}


def test_large_batches_and_lost_index_entries(spark, folder, monkeypatch):
    monkeypatch.setattr(keys, "FEW", 3)
    run(spark, world(spark, events=EVENT_ROWS[:4]), folder, loaded_at=FIRST)
    before = tables(spark, folder)

    def died(*_):
        raise RuntimeError("died before the index was written")

    with monkeypatch.context() as patch:
        patch.setattr(keys, "add", died)
        with pytest.raises(RuntimeError):
            run(spark, world(spark), folder, loaded_at=SECOND)
    run(spark, world(spark), folder, loaded_at=SECOND)
    run(spark, world(spark), f"{folder}/once", loaded_at=FIRST)
    assert tables(spark, folder) == tables(spark, f"{folder}/once") != before


def test_rows_stored_without_an_index_are_indexed_and_stay(spark, folder):
    run(spark, world(spark, events=[REPEATS[0]]), f"{folder}/a", loaded_at=FIRST)
    stored = warehouse.read_current(spark, f"{folder}/a", FACT_ACTIVITY)
    warehouse.append(stored, f"{folder}/b", FACT_ACTIVITY)
    run(spark, world(spark, events=[REPEATS[1], event("E9", "A1")]), f"{folder}/b", loaded_at=SECOND)
    rows = warehouse.read_current(spark, f"{folder}/b", FACT_ACTIVITY).collect()
    assert {(r.event_id, float(r.platform_fee_usdt)) for r in rows} == {("E1", 2.0), ("E9", 0.1)}


def test_equal_versions_are_decided_by_all_columns(spark, folder):
    run(spark, world(spark, events=[event("E1", "A1")]), f"{folder}/a", loaded_at=FIRST)
    rows = warehouse.read_current(spark, f"{folder}/a", FACT_ACTIVITY).drop("loaded_at")
    other = rows.withColumn("platform_fee_usdt", F.col("platform_fee_usdt") + 5)
    for name, parts in (("b", (rows, other)), ("c", (other, rows))):
        for part in parts:
            warehouse.append(part, f"{folder}/{name}", FACT_ACTIVITY, FIRST)
    b, c = (bag(warehouse.read_current(spark, f"{folder}/{n}", FACT_ACTIVITY)) for n in "bc")
    assert b == c and len(b) == 1


def test_append_all_is_free_of_order_too(spark, folder):
    for name, order in (("a", (0, 1)), ("b", (1, 0))):
        for n in order:
            run(
                spark, world(spark, events=[REPEATS[n]]), f"{folder}/{name}",
                loaded_at=FIRST, only_new=False,
            )
    a, b = (warehouse.read_current(spark, f"{folder}/{n}", FACT_ACTIVITY).drop("loaded_at") for n in "ab")
    assert bag(a) == bag(b)


def spoil(spark, path):
    """A file that no reader can open."""
    spark.createDataFrame([("x" * 50,)], "v string").coalesce(1).write.mode("append").text(path)


def test_a_predicate_on_the_day_prunes_months_of_the_view(spark, folder):
    events = [event(f"E{m}", "A1", f"2026-0{m}-10T00:00:00Z") for m in range(1, 7)]
    run(spark, world(spark, events=events), folder, loaded_at=FIRST)
    table = warehouse.table_path(folder, FACT_ACTIVITY)
    for month in ("202602", "202604", "202606"):
        spoil(spark, f"{table}/ym={month}")
    warehouse.register_views(spark, folder)
    january = spark.sql(
        "SELECT * FROM fact_activity_event WHERE event_date BETWEEN DATE'2026-01-01' AND DATE'2026-01-31'"
    )
    assert [r.event_id for r in january.collect()] == ["E1"]
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(ym" in plan
    assert "GreaterThanOrEqual(event_date,2026-01-01)" in plan  # below the choice of the version
    one_day = spark.sql("SELECT * FROM fact_activity_event WHERE event_date = DATE'2026-05-10'")
    assert [r.event_id for r in one_day.collect()] == ["E5"]
    with pytest.raises(Exception, match="(?i)parquet|corrupt|read"):
        spark.sql("SELECT * FROM fact_activity_event").collect()


def test_views_equal_tables(spark, folder):
    run(spark, world(spark), folder, loaded_at=FIRST)
    warehouse.register_views(spark, folder)
    for contract in WAREHOUSE.values():
        assert bag(spark.table(contract.name)) == bag(warehouse.read_current(spark, folder, contract))
        assert spark.table(contract.name).columns == [f.name for f in contract.schema]
    empty = f"{folder}-empty"
    run(spark, world(spark, events=[], sessions=[], apps=[], pams=[]), empty, loaded_at=FIRST)
    warehouse.register_views(spark, empty)
    assert all(spark.table(c.name).count() == 0 for c in WAREHOUSE.values())


def test_compaction_after_moves(spark, folder):
    for stamp, row in zip((FIRST, SECOND), (REPEATS[2], REPEATS[1])):
        run(spark, world(spark, events=[row, event("E5", "A1", "2026-02-11T00:00:00Z")]), folder, loaded_at=stamp)
    before = bag(warehouse.read_current(spark, folder, FACT_ACTIVITY))
    warehouse.compact(spark, folder, FACT_ACTIVITY)
    assert bag(warehouse.read_current(spark, folder, FACT_ACTIVITY)) == before
    run(spark, world(spark, events=[REPEATS[0]]), folder, loaded_at=THIRD)
    assert bag(warehouse.read_current(spark, folder, FACT_ACTIVITY)) == before


def test_merge_takes_what_ranks_before(spark, folder):
    run(spark, world(spark, events=[REPEATS[0]]), folder, loaded_at=FIRST)
    known = keys.known(
        spark, folder, FACT_ACTIVITY,
        spark.createDataFrame([("E1", "A1")], "event_id string, app_customer_id string"),
    ).first().known
    assert known.stored and known.rank.event_time == "2026-01-10T10:00:00Z"
    assert known.place.event_date == date(2026, 1, 10)
    assert merge.stamp(FIRST) is not None and BRIDGE.rank is None
    raw = frame(spark, "activity_events", REPEATS)
    assert raw.count() == 3


def test_a_load_moves_its_rows_once_before_they_find_their_customers(spark, folder):
    """The index meets rows where they were made unique; nothing is written in between."""
    arrived = [event("E1", "A1"), event("E2", "A2"), event("E7", "ghost")]
    run(spark, world(spark, events=arrived, sessions=[]), folder, loaded_at=FIRST)
    good = validation.accepted_events(
        validation.label_events(
            frame(
                spark,
                "activity_events",
                [
                    event("E1", "A1"),
                    event("E2", "A2", "2026-01-09T10:00:00Z"),
                    event("E4", "A4"),
                    event("E7", "ghost"),
                ],
            )
        )
    )
    key = good.select(*FACT_ACTIVITY.natural_key)
    for again, wanted in ((False, ["E2", "E4", "E7"]), (True, ["E1", "E2", "E4", "E7"])):
        opened = merge.open_to_change(
            spark, folder, FACT_ACTIVITY, validation.unique_events(good),
            validation.event_rank(), key, again,
        )
        rows = {r.event_id: r for r in opened.collect()}
        assert sorted(rows) == wanted
        assert [e for e in rows if rows[e].must_resolve] == ["E7"]
        assert rows["E4"].known is None and rows["E2"].known.rank is None
    bridge = warehouse.read_current(spark, folder, BRIDGE)
    carried = (keys.KNOWN, merge.MUST_RESOLVE)
    found = facts.activity_facts(opened, bridge, validation.event_rank().alias(RANK), *carried)
    taken = merge.with_customers_found(found, FACT_ACTIVITY)
    assert sorted(r.event_id for r in taken.collect()) == ["E1", "E2", "E4"]


def test_customer_ids_are_packed_only_where_that_is_exact(spark):
    ids = ["ab" * 32, "AB" * 32, "abc", "c1", "", "not hex", None, "00"]
    given = spark.createDataFrame([(i, v) for i, v in enumerate(ids)],
                                  "n int, canonical_customer_id string")
    short = warehouse.packed(given)
    kept = {r.n for r in short.where("__short IS NOT NULL").collect()}
    assert {0, 7} <= kept <= {0, 3, 4, 7}
    back = warehouse.unpacked(short).orderBy("n").collect()
    assert [r.canonical_customer_id for r in back] == ids


def test_tables_are_written_compressed(spark, folder):
    run(spark, world(spark, events=[event("E1", "A1")], sessions=[]), folder, loaded_at=FIRST)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    names = [r.path for r in files.select("path").collect() if "fact_activity_event" in r.path]
    assert names and all(n.endswith(".zstd.parquet") for n in names)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_written_rows_are_laid_out_without_a_shuffle(spark, folder, monkeypatch):
    """Loads of written rows: no exchange by month or bucket, a file per task and month."""
    seen = []
    for module, name in ((warehouse, "append"), (keys, "add")):
        plain = getattr(module, name)

        def spied(*given, plain=plain, **named):
            seen.append(given[-1] if len(given) == 5 else named.get("tasks"))
            return plain(*given, **named)

        monkeypatch.setattr(module, name, spied)
    events = [event(f"E{i}", "A1", f"2026-0{1 + i % 3}-10T10:00:00Z") for i in range(30)]
    for stamp in (FIRST, SECOND):
        rows = world(spark, events=[*events, event("E99", "A2")], sessions=LOGINS)
        merged = len(seen)
        run(spark, rows, folder, loaded_at=stamp, only_new=False)
        assert [n for n in seen[merged:] if n is not None] == [1, 1, 1, 1]
    rows = warehouse.read_versions(spark, folder, FACT_ACTIVITY, withdrawn=True)
    dealt = executed(warehouse._laid_out(rows.drop(warehouse.MONTH), FACT_ACTIVITY, tasks=3))
    assert "Exchange" not in dealt and "Coalesce 3" in dealt
    assert "Exchange" in executed(warehouse._laid_out(rows.drop(warehouse.MONTH), FACT_ACTIVITY))
    assert warehouse.read_current(spark, folder, FACT_ACTIVITY).count() == 31


def test_tasks_of_a_written_table(spark, folder, monkeypatch):
    spark.range(200_000).write.option("compression", "none").parquet(folder)
    size = workspace.bytes_below(spark, folder)
    assert size > 200_000
    assert warehouse.tasks_for(spark, folder) == 1
    monkeypatch.setattr(warehouse, "LEAST_BYTES", size // 3)
    assert warehouse.tasks_for(spark, folder) == 3
    monkeypatch.setattr(warehouse, "LEAST_BYTES", 1)
    assert warehouse.tasks_for(spark, folder) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(warehouse, "TASK_BYTES", size // 100)
    assert 100 <= warehouse.tasks_for(spark, folder) <= 101


def test_a_brief_lookup_leaves_other_keys_where_they_are_read(spark, folder, monkeypatch):
    monkeypatch.setattr(keys, "FEW", 0)
    events = [event(f"E{i}", "A1") for i in range(500)]
    run(spark, world(spark, events=events, sessions=[]), folder, loaded_at=FIRST)
    ids = [f"E{i}" for i in range(495, 505)]
    wanted = spark.createDataFrame([(i, "A1") for i in ids], "event_id string, app_customer_id string")
    stored = keys.read(spark, folder, FACT_ACTIVITY, wanted)
    assert stored.count() > 100
    near = {r.event_id for r in keys._near(stored, wanted, FACT_ACTIVITY).collect()}
    assert {f"E{i}" for i in range(495, 500)} <= near and len(near) < 20
    brief = keys.known(spark, folder, FACT_ACTIVITY, wanted, brief=True)
    whole = keys.known(spark, folder, FACT_ACTIVITY, wanted)
    rank = (*FACT_ACTIVITY.natural_key, "known.rank", "known.stored")
    assert bag(brief.select(*rank)) == bag(whole.select(*rank)) and brief.count() == 5


#: As the sources write them, and in other forms of the same instants.
TIMES = ["2026-01-10T10:00:00Z", "2026-01-10T10:00:00.000Z", "2026-01-10T10:00:00.250Z",
         "2026-01-10T10:00:00.000000Z", "2026-01-10T12:00:00+02:00", "2026-01-10T10:00:00.123456Z"]


def test_the_index_gives_back_the_texts_of_a_rank(spark, folder):
    events = [event(f"E{i}", "A1", t) for i, t in enumerate(TIMES)]
    logins = [session(f"S{i}", "P1", login=t, logout=t) for i, t in enumerate(TIMES)]
    run(spark, world(spark, events=events, sessions=logins), folder, loaded_at=FIRST)
    asked = spark.createDataFrame(
        [(f"E{i}", "A1", f"S{i}") for i in range(len(TIMES))],
        "event_id string, app_customer_id string, session_id string",
    )
    for contract, texts in ((FACT_ACTIVITY, ["event_time"]), (FACT_SESSION, ["login_at", "logout_at"])):
        key = asked.select(*contract.natural_key)
        found = keys.known(spark, folder, contract, key).collect()
        got = {r[0][1:]: [r.known.rank[t] for t in texts] for r in found}
        assert got == {str(i): [t] * len(texts) for i, t in enumerate(TIMES)}
        stored = keys.read(spark, folder, contract, key).select(f"rank.{texts[0]}")
        assert sorted(len(r[0]) for r in stored.collect())[:3] == [1, 1, 1]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_short_texts_are_exact_in_any_zone(spark, zone):
    given = spark.createDataFrame([(t,) for t in [*TIMES, "2026-07-01T00:30:00Z", None]], "t string")
    at = F.try_to_timestamp("t", F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        short = given.withColumn("at", at).withColumn("short", short_text(F.col("t"), F.col("at")))
        rows = short.withColumn("back", full_text(F.col("short"), F.col("at"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.back for r in rows] == [r.t for r in rows]
    assert [r.short for r in rows[:3]] == ["s", "m", "m"] and rows[6].short == "s"
