"""The ingest loop under crashes and restarts, the id index, restated days, hourly sums, purges, stored tables."""

import datetime
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from brightvault.plans import extra
from brightvault.sources import packets
from brightvault.sources.shared import place
from brightvault.streaming import commits, idindex, ingest, purge, restate, rollup
from brightvault.streaming.validate import validated

TOPIC = "source_topic string, source_partition int, source_offset long, value binary"
LATER = "received_at + INTERVAL 3 SECONDS"


def event(i, name="reaction_added", day=1, person="u", **more):
    at = f"2024-01-{day:02d}T{6 + i % 12:02d}:00:00Z"
    return json.dumps(
        {"event_id": f"e{i}", "event_name": name, "event_version": 1, "occurred_at": at, "received_at": at, "producer": "p", "privacy_class": "pseudonymous", "consent_scope": ["analytics"],
         "subject": {"user_hash": f"sha256:{person}"}, "payload": {"post_id": i % 3, "emoji_key": "heart"}} | more
    ).encode()


def records(spark, values, start=0):
    return spark.createDataFrame([("t", i % 2, start + i, v) for i, v in enumerate(values)], TOPIC)


class Loop:
    """The loop over a folder of records, a restart for every turn."""

    def __init__(self, spark, home):
        self.spark, self.home, self.out, self.next = spark, home, f"{home}/out", 0

    def add(self, values):
        records(self.spark, values, self.next).coalesce(1).write.mode("append").parquet(f"{self.home}/topic")
        self.next += len(values)

    def turn(self, per_batch=None, checkpoint="offsets", **more):
        reader = self.spark.readStream.schema(TOPIC)
        source = (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(f"{self.home}/topic")
        ends = lambda s: ingest.source_ends(s.read.schema(TOPIC).parquet(f"{self.home}/topic"))
        ingest.run_stream(source, self.out, f"{self.home}/{checkpoint}", landed_at=F.expr(LATER), ends=ends, **more).awaitTermination()

    def seen(self):
        """All that readers see."""
        rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
        return {
            "landing": rows(ingest.landing_of(self.spark, self.out).select("event_id", "source_offset", "landed_at")), "dlq": rows(ingest.dead_of(self.spark, self.out).select("source_offset", "error_code")),
            "messages": rows(ingest.messages_of(self.spark, self.out).select("key", "value")), "state": rows(ingest.state_of(self.spark, self.out)), "hours": rows(ingest.hours_of(self.spark, self.out)),
        }


class Crash(Exception):
    pass


STEPS = ["landing", "dlq", "dlq_topic", "state", "hours", "ids", "compaction", "commit", "cleaning"]


def test_a_crash_between_any_two_writes_leaves_the_batch_before(spark, tmp_path):
    """Then the replay gives what one run gives; after the manifest, the batch is there and its replay does nothing."""
    first, second = [event(0), event(1), b"x"], [event(1), event(2), b"y", event(3, day=2)]
    whole = Loop(spark, str(tmp_path / "whole"))
    for part in (first, second):
        whole.add(part)
        whole.turn()
    loop = Loop(spark, str(tmp_path / "broken"))
    loop.add(first)
    loop.turn()
    before = loop.seen()
    assert [r[0] for r in before["landing"]] == ["e0", "e1"] and len(before["dlq"]) == 1
    loop.add(second)
    for step in STEPS:

        def between(at, step=step):
            if at == step:
                raise Crash(step)

        with pytest.raises(Exception, match="Crash"):
            loop.turn(between=between)
        assert loop.seen() == (whole.seen() if step == "cleaning" else before), step
    loop.turn()
    assert loop.seen() == whole.seen()


def test_state_of_three_batches_with_restarts_is_that_of_one_query(spark, tmp_path):
    loop = Loop(spark, str(tmp_path))
    parts = [[event(i) for i in range(6)] + [b"x"], [event(2), event(7), b"", event(8, privacy_class="other")], [event(i) for i in range(4, 12)]]
    for part in parts:
        loop.add(part)
        loop.turn()
    raw = spark.read.schema(TOPIC).parquet(f"{loop.home}/topic")
    checked = validated(raw)
    want = {(r.source_topic, r.source_partition): (r.good, r.bad, r.last) for r in checked.groupBy("source_topic", "source_partition").agg(
        F.count_if(F.col("error_code").isNull()).alias("good"), F.count_if(F.col("error_code").isNotNull()).alias("bad"), F.max("source_offset").alias("last")).collect()}
    got = {(r.source_topic, r.source_partition): (r.accepted_count, r.rejected_count, r.last_offset) for r in ingest.state_of(spark, loop.out).collect()}
    assert got == want and {r.last_lag for r in ingest.state_of(spark, loop.out).collect()} == {0}
    of_topic = ingest.metrics(checked).collect()[0]
    assert sum(v[0] for v in got.values()) == of_topic.accepted_count and sum(r.landed_count for r in ingest.state_of(spark, loop.out).collect()) == of_topic.accepted_count - of_topic.duplicate_count
    assert {r.last_offset for r in ingest.checkpoints(checked).collect()} == {v[2] for v in got.values()}


def test_lag_of_an_unfinished_read_counts_what_was_not_read(spark, tmp_path):
    loop = Loop(spark, str(tmp_path))
    for i in range(3):
        loop.add([event(10 * i + j) for j in range(4)])

    def between(at):
        if at == "landing" and commits.latest(spark, loop.out):
            raise Crash("in the second batch")

    with pytest.raises(Exception, match="Crash"):
        loop.turn(per_batch=1, between=between)
    first = {r.source_partition: r for r in ingest.state_of(spark, loop.out).collect()}
    end = {r.source_partition: r.end_offset for r in ingest.source_ends(spark.read.schema(TOPIC).parquet(f"{loop.home}/topic")).collect()}
    assert sum(r.accepted_count for r in first.values()) == 4
    assert all(r.last_lag == end[p] - r.last_offset - 1 > 0 for p, r in first.items())
    loop.turn(per_batch=1)
    assert {r.last_lag for r in ingest.state_of(spark, loop.out).collect()} == {0}


def test_end_offsets_come_from_the_progress_of_a_query(spark):
    ends = ingest.ProgressEnds()
    told = lambda offsets: ends.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(sources=[SimpleNamespace(latestOffset=offsets)])))
    for offsets in ('{"t":{"0":5,"1":7}}', '{"t":{"1":9}}', None, '{"logOffset":3}', "17"):
        told(offsets)
    assert sorted(map(tuple, ends.frame(spark).collect())) == [("t", 0, 5), ("t", 1, 9)]


def test_index_of_ids_is_exact_opens_few_files_and_has_few_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(idindex, "IN_BLOCK", 8)
    monkeypatch.setattr(idindex, "BLOCKS", 2)
    root, runs, landed, most = str(tmp_path), [], set(), 0
    size = 12
    for n in range(50):
        ids = [f"id{n}-{i}" for i in range(size)] + sorted(landed)[n : n + 2]
        df = idindex.hashed(spark.createDataFrame([(i,) for i in ids], "event_id string"))
        if n % 7 == 6 or n < 3:  # in between only runs are added: a lookup takes a second
            found, opened = idindex.known(df, root, runs)
            assert (set() if found is None else {r.event_id for r in found.collect()}) == set(ids) & landed
            files = sum(-(-r.blocks // 2) for r in runs)
            assert len(opened) <= 2 * len(runs) and (n < 20 or len(opened) < files)
        new = [i for i in ids if i not in landed]
        fresh = idindex.hashed(spark.createDataFrame([(i,) for i in new], "event_id string"))
        runs.append(idindex.write_run(fresh, root, f"batch-{n}", 0))
        runs, _ = idindex.compacted(spark, root, runs, f"merged-{n}")
        landed |= set(new)
        most = max(most, len(runs))
    assert sum(r.rows for r in runs) == len(landed) and most <= (idindex.FAN - 1) * 3 + 1


def test_an_id_that_no_run_has_opens_no_file(spark, tmp_path):
    ids = idindex.hashed(spark.createDataFrame([(f"a{i}",) for i in range(300)], "event_id string"))
    run = idindex.write_run(ids, str(tmp_path), "r", 0)
    other = idindex.hashed(spark.createDataFrame([(f"b{i}",) for i in range(50)], "event_id string"))
    assert idindex.known(other, str(tmp_path), [run]) == (None, [])


def test_hourly_sums_are_right_before_during_and_after_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rollup, "MOST", 3)
    loop = Loop(spark, str(tmp_path))

    def right():
        want = {tuple(r) for r in rollup.partial(ingest.landing_of(spark, loop.out)).collect()}
        assert {tuple(r) for r in ingest.hours_of(spark, loop.out).collect()} == want

    for n in range(4):
        loop.add([event(10 * n + i, day=1 + n % 2) for i in range(5)])
        if n == 2:
            old = commits.latest(spark, loop.out)["hours"]

            def between(at):
                if at == "ids":  # the segments have been put together, and no manifest says so yet
                    raise Crash("during")

            with pytest.raises(Exception, match="Crash"):
                loop.turn(between=between)
            right()
            held = rollup.summed(spark, old)
            before = {tuple(r) for r in held.collect()}
        loop.turn()
        right()
        if n == 2:
            assert len(commits.latest(spark, loop.out)["hours"]) == 1
            assert {tuple(r) for r in held.collect()} == before  # a reader of the older manifest
    assert len(commits.latest(spark, loop.out)["hours"]) == 2


def files_of(spark, table):
    out = {}
    for value, folder in table.folders.items():
        hadoop, system = place(spark, folder)
        out[value] = sorted((str(f.getPath()), f.getModificationTime()) for f in system.listStatus(hadoop))
    return out


def test_a_late_batch_restates_its_days_only(spark, tmp_path):
    loop, models = Loop(spark, str(tmp_path)), ("s_reaction_valence_daily",)
    daily = f"{loop.home}/daily"
    for day in (1, 2, 3):
        loop.add([event(100 * day + i, day=day, person=f"u{i}") for i in range(6)])
    loop.turn()
    assert restate.restate(spark, loop.out, daily, models) == [datetime.date(2024, 1, d) for d in (1, 2, 3)]
    table = restate.Partitioned(spark, f"{daily}/{models[0]}", "reporting_date")
    before = files_of(spark, table)
    loop.add([event(900, day=2, person="late"), event(901, day=2, person="later")])
    loop.turn()
    assert restate.restate(spark, loop.out, daily, models) == [datetime.date(2024, 1, 2)]
    after = files_of(spark, table)
    assert {v for v in after if after[v] != before.get(v)} == {"2024-01-02"}
    assert restate.restate(spark, loop.out, daily, models) == []
    from brightvault.plans.catalog import daily_frames

    full = daily_frames(ingest.landing_of(spark, loop.out).drop("batch", "reporting_date"), models)[models[0]]
    order = sorted(full.columns)
    assert sorted(map(repr, table.read().select(*order).collect())) == sorted(map(repr, full.select(*order).collect()))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    rows = restate.landing_of_days(spark, loop.out, restate.touched(spark, loop.out, 0))
    plan = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "dynamicpruning" in next(x for x in plan.split("\n") if x.startswith("PartitionFilters"))


def test_upserts_rewrite_touched_partitions_and_the_last_write_wins(spark, tmp_path):
    table = restate.Partitioned(spark, str(tmp_path), "day")
    ddl = "id string, day string, at int, n int"
    put = lambda *rows: restate.upsert(table, spark.createDataFrame(rows, ddl), "id", "at")
    assert table.read() is None
    put(("a", "d1", 1, 1), ("b", "d2", 1, 1), ("a", "d1", 0, 9))
    before = files_of(spark, table)
    assert put(("b", "d2", 1, 2), ("c", "d2", 5, 3), ("c", "d2", 4, 4)) == ["d2"]  # ties go to the new row
    put(("c", "d2", 3, 7))  # an older one
    assert sorted(map(tuple, table.read().select("id", "n").collect())) == [("a", 1), ("b", 2), ("c", 3)]
    assert files_of(spark, table)["d1"] == before["d1"]
    with pytest.raises(ValueError, match="not replaced"):
        table.replace(spark.createDataFrame([("z", "d9", 1, 1)], ddl), ["d1"])
    table.replace(spark.createDataFrame([], ddl), ["d1"])
    assert "d1" not in table.folders and table.read(["d1"]).count() == 0


def test_findings_close_when_their_check_passes(spark, tmp_path):
    runs, findings = (restate.Partitioned(spark, str(tmp_path / n), "window_day") for n in ("runs", "findings"))
    day = lambda d: datetime.date(2024, 1, d)
    run = lambda at, *rows: extra.store_run(runs, findings, spark.createDataFrame(rows, "event_name string, window_day date, n long, failures long"), at)
    run("2024-02-01 00:00:00", ("x", day(1), 5, 2), ("y", day(2), 5, 1), ("z", day(2), 5, 0))
    kept = files_of(spark, findings)["2024-01-02"]
    run("2024-02-02 00:00:00", ("x", day(1), 5, 0))
    state = {r.id: (r.status, r.sample_count, r.resolved_at is not None) for r in findings.read().collect()}
    assert state == {"quality:2024-01-01:x:critical:1": ("resolved", 2, True), "quality:2024-01-02:y:critical:1": ("open", 1, False)}
    assert files_of(spark, findings)["2024-01-02"] == kept
    run("2024-02-03 00:00:00", ("x", day(1), 5, 4))  # it opens again, and keeps the time it was first seen
    again = findings.read(["2024-01-01"]).collect()[0]
    assert (again.status, again.sample_count, again.resolved_at, str(again.created_at)) == ("open", 4, None, "2024-02-01 00:00:00")
    assert {r.contract_name: r.status for r in runs.read().collect()} == {"x": "failed", "y": "failed", "z": "passed"}


def test_a_purged_person_leaves_the_tables_and_stays_out(spark, tmp_path, monkeypatch):
    loop = Loop(spark, str(tmp_path))
    loop.add([event(i, day=1 + i % 3, person=f"p{i % 4}") for i in range(12)] + [event(90, day=9)])
    loop.turn()
    gone = spark.createDataFrame([("person", "sha256:p1"), ("event", "e2")], "kind string, key string")
    landed = lambda: sorted(r.event_id for r in ingest.landing_of(spark, loop.out).collect())
    stay = sorted({f"e{i}" for i in range(12) if i % 4 != 1 and i != 2} | {"e90"})
    # The purge breaks when the rows that stay have been written aside and marked.
    monkeypatch.setattr(purge, "settle", lambda *_: None)
    purge.purge(spark, loop.out, gone)
    assert landed() == stay  # by the tombstones
    raw = lambda: sorted(r.event_id for r in spark.read.parquet(f"{loop.out}/landing").collect())
    assert "e1" in raw()
    monkeypatch.undo()
    untouched = [f for f in spark.read.parquet(f"{loop.out}/landing").inputFiles() if "2024-01-09" in f]
    purge.settle(spark, loop.out)
    purge.settle(spark, loop.out)
    assert raw() == landed() == stay
    assert [f for f in spark.read.parquet(f"{loop.out}/landing").inputFiles() if "2024-01-09" in f] == untouched
    loop.add([event(1, person="p1"), event(2, person="p2"), event(50, person="p1"), event(51, person="p0")])  # late, and again
    loop.turn()
    loop.turn(checkpoint="a-replay-from-the-start")
    assert landed() == sorted([*stay, "e51"]) == raw()
    assert purge.purge(spark, loop.out, gone) == []
    with pytest.raises(ValueError, match="kind"):
        purge.purge(spark, loop.out, spark.createDataFrame([("place", "x")], "kind string, key string"))


def test_a_request_runs_once_over_restarts(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("inbox", "out", "state"))
    ask = lambda kind, key=None: json.dumps({"request_type": kind} | ({"request_id": key} if key else {}))
    turns = [
        [ask("account_deletion", "r1"), " ", "{broken", ask("sing", "r2"), ask("account_deletion", "r1")], [ask("account_deletion", "r1"), ask("recap_opt_out", "r1"), ask("recap_opt_out")], [ask("recap_opt_out"), "[1]", "7", ""],
    ]
    for lines in turns:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(inbox)
        extra.request_stream(spark.readStream.text(inbox), out, state).awaitTermination()
    got = sorted(r.run_key for r in spark.read.parquet(out).collect())
    assert got[:2] == ["account_deletion:r1", "recap_opt_out:line-" + got[1].split("line-")[1]] and got[2:] == ["recap_opt_out:r1"]


GOOD = {
    "sourceRecordRef": "rec:1", "subjectRef": "sha256:ab", "featureId": "f", "dataState": "ANONYMOUS", "occurredAt": "2024-01-01T00:00:00Z", "retentionDays": 3, "expiryAction": "delete", "anonymizationTarget": "t",
    "anonymousGroup": "g", "cellCount": 0, "candidateIdentifierFree": True, "methodVersion": "m", "evidenceId": "e",
}


def test_packets_give_a_row_per_record_and_wrong_types_an_error_of_their_row(spark, tmp_path):
    changes = [
        ({}, None), ({"requestType": "recap_opt_out", "privateRecapCounter": True}, None), ({"requestType": None}, None), ({"retentionDays": "3"}, "retentionDays"), ({"retentionDays": 3.5}, "retentionDays"), ({"cellCount": True}, "cellCount"),
        ({"cellCount": 3_000_000_000}, "cellCount"), ({"candidateIdentifierFree": "yes"}, "candidateIdentifierFree"), ({"occurredAt": "2024-01-01T00:00:00"}, "occurredAt"), ({"occurredAt": 5}, "occurredAt"), ({"evidenceId": None}, "evidenceId"),
        ({"featureId": " "}, "featureId"), ({"requestType": 4}, "requestType"), ({"demographicOrRareCell": 1}, "demographicOrRareCell"), ({"unknown": {"deep": [1]}}, None),
    ]
    rows = [GOOD | {"sourceRecordRef": f"rec:{i}"} | c for i, (c, _) in enumerate(changes)]
    (tmp_path / "one.json").write_text(json.dumps({"schemaVersion": "v", "sourceBinding": {"a": 1}, "records": rows[:4]}, indent=2))
    (tmp_path / "two.json").write_text(json.dumps({"schemaVersion": "v", "records": rows[4:]}, indent=2))
    (tmp_path / "broken.json").write_text('{"records": [\n')
    (tmp_path / "empty.json").write_text('{"schemaVersion": "v"}')
    got = packets.read_packets(spark, str(tmp_path)).collect()
    found = {r.source_record_ref: r for r in got if r.source_record_ref}
    assert [found[f"rec:{i}"].field_error for i in range(len(changes))] == [e for _, e in changes]
    assert sorted(r.corrupt_packet for r in got if r.corrupt_packet is not None) == ["", '{"records": [\n'] and len(got) == len(changes) + 2
    assert found["rec:0"].retention_days == 3 and found["rec:0"].demographic_or_rare_cell is False and found["rec:1"].private_recap_counter is True and found["rec:3"].retention_days is None
