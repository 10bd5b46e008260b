"""Whole runs over small text feeds."""

import hashlib
import json

import pytest
from feeds import OFFERS, booking, payment, scenario, write_feeds

from tidemark import DataContractError, run_pipeline
from tidemark.plans import catalogues as c
from tidemark.plans import checks as k
from tidemark.plans import evidence
from tidemark.plans.bookings import Strictness
from tidemark.plans.batch import replay_check, speed_check
from tidemark.session import tune
from tidemark.sinks import commits
from tidemark.sinks.writers import batch_path, read_document


def failed(run):
    return {check["check_id"] for check in run.checks if check["status"] == "FAIL"}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """One lake: a batch run twice, and another batch in the faulty mode."""
    root = tmp_path_factory.mktemp("lake")
    source = write_feeds(root / "source", *scenario(400))
    target = str(root / "lake")
    first = run_pipeline(spark, source, target, batch_id="B1")
    again = run_pipeline(spark, source, target, batch_id="B1", mode="fixed")
    buggy = run_pipeline(spark, source, target, batch_id="002", mode="buggy")
    return {"source": source, "target": target, "first": first, "again": again, "buggy": buggy}


def test_volumes_of_the_known_scenario(lake):
    metrics = lake["first"].metrics
    assert metrics["source_rows"] == {"bookings": 419, "payments": 413, "offers": 5}
    assert metrics["silver_rows"] == {"bookings": 406, "payments": 406}
    assert metrics["superseded_bookings"] == 1
    assert metrics["quarantine_rows"] == 19
    assert metrics["quarantine_reasons"] == {
        c.MISSING_REQUIRED: 6,
        c.INVALID_STATUS: 4,
        c.INVALID_DATE_ORDER: 1,
        c.NEGATIVE_AMOUNT: 2,
        c.UNSUPPORTED_CURRENCY: 2,
        c.UNKNOWN_OFFER: 2,
        c.MISSING_PAYMENT: 1,
        c.AMOUNT_MISMATCH: 1,
    }
    assert metrics["reconciliation"]["difference"] == 0
    assert metrics["reconciliation"]["quarantined_bookings"] == 12
    assert metrics["success_rate_percent"] == 97.14
    assert lake["first"].decision == "GO"


def test_replay_changes_nothing_in_gold(lake):
    first, again = lake["first"], lake["again"]
    assert first.metrics["gold_hash_sha256"] == again.metrics["gold_hash_sha256"]
    assert first.metrics["gold_rows"] == again.metrics["gold_rows"]
    status = {run: {x["check_id"]: x["status"] for x in lake[run].checks} for run in ("first", "again")}
    assert status["first"]["AC09"] == "NOT_EVALUATED"
    assert status["again"]["AC09"] == "PASS"


def test_oldest_mode_fails_only_the_newest_version_check(lake):
    assert failed(lake["buggy"]) == {"AC04B"}
    assert lake["buggy"].decision == "NO-GO"
    controls = k.control_checks(lake["buggy"].layers).where("status = 'FAIL'").collect()
    assert [row["check_id"] for row in controls] == ["AC04B"]


def test_controls_and_listings_of_a_clean_batch(lake):
    layers = lake["again"].layers
    checks = evidence.validation_results(k.control_checks(layers)).collect()
    assert [row["check_id"] for row in checks] == sorted(k.CONTROLS)
    assert {row["status"] for row in checks} == {"PASS"}
    differences = k.gold_differences(k.recalculated(layers), layers.daily_revenue)
    assert evidence.ordered_differences(differences).collect() == []
    causes = evidence.rejects_by_cause(layers.quarantine).collect()
    assert [(row["source_entity"], row["rejected_rows"]) for row in causes] == [
        ("bookings", n) for n in (3, 3, 2, 1, 1, 1, 1)
    ] + [("payments", n) for n in (3, 1, 1, 1, 1)]


def test_batches_are_kept_apart(lake, spark):
    batches = commits.read_table(tune(spark), lake["target"], "silver/bookings").select("batch_id").distinct()
    assert {row["batch_id"] for row in batches.collect()} == {"B1", "002"}
    one = commits.read_table(tune(spark), lake["target"], "silver/bookings", ["002"])
    assert one.count() == lake["buggy"].layers.silver_bookings.count() and "run_id" not in one.columns


def test_silver_has_the_newest_version_and_no_raw_client(lake):
    silver = lake["again"].layers.silver_bookings
    row = silver.where("booking_id = 'R1'").first()
    assert str(row["updated_at"]) == "2031-03-06 08:00:00"
    assert "client_id" not in silver.columns
    assert len(row["client_id_hash"]) == 64


def test_gold_of_the_superseded_booking(lake):
    detail = lake["again"].layers.revenue_detail
    row = detail.where("booking_id = 'R1'").first()
    assert (str(row["gross_amount"]), row["destination"], row["payment_status"]) == ("80.00", "Trondheim", "PAID")
    ids = {r["booking_id"] for r in detail.select("booking_id").collect()}
    assert ids >= {"R1", "R2", "R18", "R1001"}
    assert not ids & {f"R{n}" for n in range(3, 18)}


def test_rejects_are_traceable(lake):
    rows = lake["again"].layers.quarantine.collect()
    found = {(r["source_entity"], r["record_id"], r["reason_code"]): r for r in rows}
    assert ("bookings", "R7", c.MISSING_REQUIRED) in found
    assert ("bookings", "R6", c.MISSING_PAYMENT) in found
    missing = found["bookings", "R6", c.MISSING_PAYMENT]
    assert missing["source_row_number"] is None
    assert missing["source_file"] == "bookings.csv"
    orphan = found["payments", "T8", c.MISSING_REQUIRED]
    assert orphan["details"] == c.NO_BOOKING
    assert orphan["source_row_number"] == 8
    assert found["bookings", "R16", c.MISSING_REQUIRED]["source_row_number"] == 17
    assert ("bookings", "R17", c.INVALID_STATUS) in found


def test_manifest_and_lineage(lake):
    rows = lake["again"].layers.manifest.collect()
    assert {r["source_file"] for r in rows} == {"bookings.csv", "payments.jsonl", "offers.csv"}
    assert {r["batch_id"] for r in rows} == {"B1"}
    assert all(len(r["checksum"]) == 64 and r["size_bytes"] > 0 for r in rows)
    bronze = lake["again"].layers.bronze_bookings
    stamped = bronze.select("source_file", "source_checksum").distinct().collect()
    wanted = next(r["checksum"] for r in rows if r["source_file"] == "bookings.csv")
    assert [(r["source_file"], r["source_checksum"]) for r in stamped] == [("bookings.csv", wanted)]
    numbers = sorted(r["source_row_number"] for r in bronze.select("source_row_number").collect())
    assert numbers == list(range(1, 420))


def test_report_document_and_checks_table(lake, spark):
    run_id = commits.current_run(spark, lake["target"], "B1")
    report = read_document(spark, lake["target"], "reports/quality_report", "B1", run_id)
    assert report["summary"]["decision"] == "GO"
    assert report["summary"]["failed"] == 0
    assert report["run"]["dedup_mode"] == "latest"
    manifest = read_document(spark, lake["target"], "bronze/manifest_document", "B1", run_id)
    assert [f["file_name"] for f in manifest["feeds"]] == ["bookings.csv", "payments.jsonl", "offers.csv"]
    checks = spark.read.parquet(lake["first"].paths["quality_checks"])
    assert checks.count() == len(k.GATE)
    assert json.loads(checks.where("check_id = 'AC01'").first()["actual_json"]) is True
    summary = spark.read.parquet(lake["first"].paths["quality_summary"]).first()
    assert (summary["raw_count"], summary["reconciliation_delta"]) == (419, 0)


def test_gate_can_stop_the_caller(lake, spark, tmp_path):
    with pytest.raises(k.QualityGateError, match="AC04B"):
        run_pipeline(
            spark, lake["source"], str(tmp_path), mode="buggy", fail_on_quality=True
        )


def test_unreadable_earlier_report_is_ignored(spark, tmp_path):
    assert read_document(spark, str(tmp_path), "reports/quality_report", "X") is None
    folder = tmp_path / "reports/quality_report/batch_id=X"
    folder.mkdir(parents=True)
    (folder / "part-0.txt").write_text("{not json")
    assert read_document(spark, str(tmp_path), "reports/quality_report", "X") is None


def test_replay_check_sees_a_changed_result():
    metrics = {"gold_rows": 1, "gold_gross_revenue_eur": 2.0, "gold_hash_sha256": "a"}
    report = {
        "run": {"source_fingerprint_sha256": "f", "dedup_mode": "latest"},
        "metrics": {**metrics, "gold_hash_sha256": "b"},
    }
    assert replay_check(report, "f", "latest", metrics)["status"] == "FAIL"
    assert replay_check(report, "g", "latest", metrics)["status"] == "NOT_EVALUATED"
    assert replay_check(report, "f", "oldest", metrics)["status"] == "NOT_EVALUATED"


def test_speed_check():
    def metrics(rows, seconds, difference=0):
        return {
            "source_rows": {"bookings": rows},
            "duration_seconds": seconds,
            "reconciliation": {"difference": difference},
        }

    assert speed_check(metrics(99_999, 1))["status"] == "NOT_EVALUATED"
    assert speed_check(metrics(100_000, 29.9))["status"] == "PASS"
    assert speed_check(metrics(100_000, 30))["status"] == "FAIL"
    assert speed_check(metrics(100_000, 1, 2))["status"] == "FAIL"


def test_gate_decision_follows_severity():
    def check(severity, status):
        return {"check_id": "X", "severity": severity, "status": status}

    assert k.decide([check("MEDIUM", "FAIL"), check("HIGH", "NOT_EVALUATED")]) == "GO"
    assert k.decide([check("HIGH", "FAIL")]) == "NO-GO"
    assert k.decide([check("CRITICAL", "FAIL")]) == "NO-GO"


def test_an_empty_replay_leaves_no_old_rows(spark, tmp_path):
    target = str(tmp_path / "lake")
    run_pipeline(spark, write_feeds(tmp_path / "full", *scenario(10)), target, batch_id="B")
    rows = [booking(i, currency="CHF") for i in range(1, 31)]
    payments = [payment(i, row) for i, row in enumerate(rows, 1)]
    run = run_pipeline(spark, write_feeds(tmp_path / "bad", rows, payments), target, batch_id="B")
    assert run.metrics["silver_rows"] == {"bookings": 0, "payments": 0}
    assert run.metrics["gold_rows"] == 0
    assert run.metrics["gold_gross_revenue_eur"] == "0.00"
    assert run.metrics["success_rate_percent"] == 0.0
    assert commits.read_table(spark, target, "silver/bookings").count() == 0
    assert commits.read_table(spark, target, "gold/daily_revenue").count() == 0
    assert run.decision == "GO"


def stored(target):
    return {p.relative_to(target): p.read_bytes() for p in target.rglob("part-*")}


def test_a_replay_that_fails_changes_nothing(spark, tmp_path):
    target = tmp_path / "lake"
    run_pipeline(spark, write_feeds(tmp_path / "good", *scenario()), str(target), batch_id="B")
    before = stored(target)
    rows, payments = scenario()
    rows[1]["gross_amount"] = payments[1]["amount"] = "99999999999.00"
    with pytest.raises(Exception, match="amount does not fit"):
        run_pipeline(spark, write_feeds(tmp_path / "wide", rows, payments), str(target), batch_id="B")
    assert stored(target) == before
    source = write_feeds(tmp_path / "few", [rows[0]], payments[:1])
    run_pipeline(spark, source, str(target), batch_id="B", keep_runs=1)
    lines = commits.read_table(spark, str(target), "bronze/raw_lines")
    assert lines.where("source_name = 'bookings'").count() == 2
    assert not before.keys() & stored(target).keys()


def test_the_later_of_two_runs_withdraws(spark, tmp_path, monkeypatch):
    """A whole run of the same batch goes through just before the first one commits."""
    target, source = tmp_path / "lake", write_feeds(tmp_path / "source", *scenario())
    commit, runs = commits.commit, []

    def overtaken(*args, **options):
        if not runs:
            runs.append("inner")
            runs.append(run_pipeline(spark, source, str(target), batch_id="B"))
        return commit(*args, **options)

    monkeypatch.setattr(commits, "commit", overtaken)
    with pytest.raises(commits.CommitConflict, match="batch B"):
        run_pipeline(spark, source, str(target), batch_id="B")
    won = runs[1].paths["gold"].rpartition("run_id=")[2]
    assert commits.committed_runs(spark, str(target), "B") == [won]
    assert {p.name for p in (target / "gold/daily_revenue/batch_id=B").iterdir()} == {f"run_id={won}"}
    assert commits.read_table(spark, str(target), "gold/daily_revenue").collect()


class Killed(BaseException):
    pass


def test_a_program_killed_at_any_write_leaves_the_old_or_the_new(spark, tmp_path, monkeypatch):
    """The driver dies without a chance to tidy up, before, in and behind the commit."""
    target, source = tmp_path / "lake", write_feeds(tmp_path / "source", *scenario())
    first = run_pipeline(spark, source, str(target), batch_id="B")
    other = write_feeds(tmp_path / "other", *scenario(3))
    gold = lambda: commits.read_table(spark, str(target), "silver/bookings").count()
    old = gold()
    monkeypatch.setattr(commits, "withdraw", lambda *args: None)
    commit = commits.commit

    def die(*args):
        raise Killed

    monkeypatch.setattr(commits, "commit", die)
    with pytest.raises(Killed):
        run_pipeline(spark, other, str(target), batch_id="B")
    assert gold() == old and commits.committed_runs(spark, str(target), "B") == [first.paths["gold"].rpartition("run_id=")[2]]

    def cut_off(spark, root, batch_id, run_id, after):  # the pointer is there, but nothing is in it
        commit(spark, root, batch_id, run_id, after)
        (target / f"_commits/batch_id={batch_id}" / f"{after + 1:010d}").write_text("")
        (target / f"_commits/batch_id={batch_id}" / f".{after + 1:010d}.crc").unlink(missing_ok=True)
        raise Killed

    monkeypatch.setattr(commits, "commit", cut_off)
    with pytest.raises(Killed):
        run_pipeline(spark, other, str(target), batch_id="B")
    assert gold() == old

    def done(*args):
        commit(*args)
        raise Killed

    monkeypatch.setattr(commits, "commit", done)
    with pytest.raises(Killed):
        run_pipeline(spark, other, str(target), batch_id="B")
    assert gold() == old + 3

    monkeypatch.undo()
    tables = ["gold/daily_revenue", "silver/bookings"]
    assert len(commits.prune(spark, str(target), tables, "B", idle_hours=1)) == 0
    assert len(commits.prune(spark, str(target), tables, "B", idle_hours=0)) == 2
    assert gold() == old + 3


def test_pointers_are_created_once(spark, tmp_path):
    root = str(tmp_path)
    assert commits.current_run(spark, root, "B") is None and commits.batches(spark, root) == {}
    with pytest.raises(FileNotFoundError):
        commits.read_table(spark, root, "t")
    for run in ("one", "two", "three"):
        spark.range(len(run)).write.parquet(batch_path(root, "t", "B", run))
    commits.commit(spark, root, "B", "one", 0)
    commits.commit(spark, root, "B", "two", 1)
    with pytest.raises(commits.CommitConflict):
        commits.commit(spark, root, "B", "three", 1)
    assert commits.read_table(spark, root, "t").count() == 3 and commits.last_number(spark, root, "B") == 2
    assert commits.prune(spark, root, ["t"], "B", keep=1) == ["one"]
    assert commits.committed_runs(spark, root, "B") == ["two", "one"]


def test_quotes_and_line_breaks_in_fields(spark, tmp_path):
    rows, payments = scenario()
    rows[0]["client_id"], rows[1]["client_id"] = "two\nlines", 'a "quoted" name'
    source = write_feeds(tmp_path / "source", rows, payments)
    text = (tmp_path / "source/bookings.csv").read_text()
    (tmp_path / "source/bookings.csv").write_text(text.replace("guest one", '5" pipe'))
    run = run_pipeline(spark, source, str(tmp_path / "lake"))
    assert run.metrics["source_rows"]["bookings"] == len(rows)
    assert run.metrics["quarantine_reasons"] == {**run.metrics["quarantine_reasons"], c.MISSING_REQUIRED: 6}
    names = {r["client_id"] for r in run.layers.bronze_bookings.collect()}
    assert {"two\nlines", 'a "quoted" name', '5" pipe'} <= names
    flat = run_pipeline(spark, source, str(tmp_path / "flat"), multi_line_csv=False)
    assert flat.metrics["source_rows"]["bookings"] == len(rows) + 1


def test_the_text_of_a_broken_line_is_in_bronze(spark, tmp_path):
    source = write_feeds(tmp_path / "source", *scenario())
    with open(tmp_path / "source/payments.jsonl", "a") as out:
        out.write('{"payment_id": "cut\n')
    run = run_pipeline(spark, source, str(tmp_path / "lake"))
    assert run.metrics["quarantine_reasons"][c.MISSING_REQUIRED] == 7
    lines = commits.read_table(spark, str(tmp_path / "lake"), "bronze/raw_lines")
    assert b'{"payment_id": "cut' in {bytes(r["value"]) for r in lines.collect()}


def test_the_callers_session_keeps_its_settings(spark, tmp_path):
    mine = spark.newSession()
    mine.conf.set("spark.sql.ansi.enabled", "false")
    mine.conf.set("spark.sql.shuffle.partitions", "3")
    run = run_pipeline(mine, write_feeds(tmp_path / "source", *scenario()), str(tmp_path / "lake"))
    assert run.decision == "GO"
    assert mine.conf.get("spark.sql.ansi.enabled") == "false"
    assert run.layers.daily_revenue.sparkSession.conf.get("spark.sql.shuffle.partitions") == "3"


def test_a_feed_of_headers_only(spark, tmp_path):
    source = write_feeds(tmp_path / "source", *scenario())
    header = (tmp_path / "source/bookings.csv").read_text().splitlines()[0]
    (tmp_path / "source/bookings.csv").write_text(header + "\n")
    run = run_pipeline(spark, source, str(tmp_path / "lake"))
    assert run.metrics["source_rows"]["bookings"] == 0
    assert run.metrics["success_rate_percent"] == 100.0
    assert run.metrics["quarantine_reasons"] == {c.MISSING_REQUIRED: 10, c.INVALID_STATUS: 1, c.NEGATIVE_AMOUNT: 1, c.UNSUPPORTED_CURRENCY: 1}
    assert run.decision == "GO"


def test_modes_and_names_are_checked(spark, tmp_path):
    for wrong in ({"mode": "fast"}, {"dedup_mode": "newest"}, {"batch_id": "a/b"}):
        with pytest.raises(ValueError):
            run_pipeline(spark, str(tmp_path), str(tmp_path), **wrong)


def test_missing_files_are_listed_together(spark, tmp_path):
    folder = write_feeds(tmp_path / "source", *scenario())
    (tmp_path / "source/payments.jsonl").unlink()
    (tmp_path / "source/offers.csv").unlink()
    with pytest.raises(FileNotFoundError, match="payments.jsonl.*offers.csv"):
        run_pipeline(spark, folder, str(tmp_path / "lake"))


def test_a_missing_column_stops_the_run(spark, tmp_path):
    rows, payments = scenario()
    for row in rows:
        del row["updated_at"]
    with pytest.raises(DataContractError, match="bookings.csv lacks updated_at"):
        run_pipeline(spark, write_feeds(tmp_path / "s", rows, payments), str(tmp_path / "lake"))


# --- behaviour that is easy to get wrong -------------------------------------------------------


def small_run(spark, tmp_path, bookings, payments, offers=OFFERS, **options):
    source = write_feeds(tmp_path / "source", bookings, payments, offers)
    return run_pipeline(spark, source, str(tmp_path / "lake"), **options)


def reasons(run):
    return {
        row["record_id"]: row["reason_code"]
        for row in run.layers.quarantine.collect()
    }


def test_duplicate_offers_fan_out_and_show_in_the_reconciliation(spark, tmp_path):
    row = booking(4)
    offers = [*OFFERS, OFFERS[0]]
    run = small_run(spark, tmp_path, [row], [payment(1, row)], offers)
    assert run.metrics["superseded_bookings"] == 1
    assert run.metrics["reconciliation"]["difference"] == -1
    assert failed(run) == {"AC03"}


def test_an_amount_too_wide_for_silver_stops_the_batch(spark, tmp_path):
    row = booking(4, gross_amount="99999999999.00")
    with pytest.raises(Exception, match="amount does not fit.*R4"):
        small_run(spark, tmp_path, [row], [payment(1, row)])


def test_keys_match_as_written_but_codes_do_not_care_about_case(spark, tmp_path):
    rows = [
        booking(4, offer_id=" attic "),
        booking(8, booking_status=" confirmed ", currency="eur", source_channel="web "),
        booking(12, booking_id=" R8"),
    ]
    run = small_run(spark, tmp_path, rows, [payment(1, booking(8))])
    assert reasons(run) == {"R4": c.UNKNOWN_OFFER, " R8": c.MISSING_PAYMENT}
    silver = run.layers.silver_bookings.first()
    assert (silver["booking_status"], silver["currency"], silver["source_channel"]) == (
        "CONFIRMED",
        "EUR",
        "WEB",
    )


def test_paid_at_of_declined_payments(spark, tmp_path):
    row = booking(9, booking_status="PENDING")
    paid = payment(1, row, payment_status="DECLINED", paid_at="")
    lax = Strictness(paid_at_required_for=("PAID", "REFUNDED"))
    strict_run = small_run(spark, tmp_path / "a", [row], [paid])
    assert reasons(strict_run) == {"T1": c.MISSING_REQUIRED}
    assert strict_run.layers.quarantine.first()["details"] == c.ROW_FAILED
    assert reasons(small_run(spark, tmp_path / "b", [row], [paid], strict=lax)) == {}


def test_unreadable_flags_and_rates_are_accepted_unless_asked(spark, tmp_path):
    offers = [("A", "Oslo", "0.1", "maybe"), ("B", "Bern", "", "true"), ("C", "Graz", "1.5", "true")]
    rows = [booking(i, offer_id=o[0], booking_status="PENDING") for i, o in enumerate(offers, 1)]
    payments = [payment(i, row) for i, row in enumerate(rows, 1)]
    run = small_run(spark, tmp_path / "a", rows, payments, offers)
    assert reasons(run) == {}
    strict = Strictness(active_must_be_known=True, rate_must_be_fraction=True)
    run = small_run(spark, tmp_path / "b", rows, payments, offers, strict=strict)
    rejected = {name: reason for name, reason in reasons(run).items() if name.startswith("R")}
    assert rejected == {row["booking_id"]: c.UNKNOWN_OFFER for row in rows}


def test_a_later_mismatched_payment_is_a_finding_of_the_recalculation(spark, tmp_path):
    row = booking(4)
    good = payment(1, row, paid_at="2031-03-07T10:00:00Z")
    late = payment(2, row, paid_at="2031-03-08T10:00:00Z", amount="1.00")
    run = small_run(spark, tmp_path, [row], [good, late])
    assert run.metrics["gold_rows"] == 1
    assert run.decision == "GO"
    controls = k.control_checks(run.layers).where("status = 'FAIL'").collect()
    assert {r["check_id"] for r in controls} == {"AC06", "AC10"}


def test_equal_payment_times_are_decided_by_id(spark, tmp_path):
    row = booking(4)
    payments = [payment(2, row), payment(1, row, payment_status="REFUNDED")]
    run = small_run(spark, tmp_path, [row], payments)
    assert run.layers.revenue_detail.first()["payment_id"] == "T2"


def test_a_hot_booking_gives_the_same_ranks_by_sort_as_by_window(spark, tmp_path):
    rows = [booking(i) for i in range(1, 31)]
    rows += [booking(400, updated_at=f"2031-03-06T09:{i % 7:02d}:00Z") for i in range(15)]
    payments = [payment(i, row) for i, row in enumerate(rows[:31], 1)]
    runs = [
        small_run(spark, tmp_path / str(hot), rows, payments, hot_rows=hot) for hot in (10, 1000)
    ]
    by_sort, by_window = [
        {(r["updated_at"], r["dedup_rank"]) for r in run.layers.superseded.collect()} for run in runs
    ]
    assert by_sort == by_window
    assert {rank for _, rank in by_sort} == set(range(2, 16))
    assert runs[0].metrics["gold_hash_sha256"] == runs[1].metrics["gold_hash_sha256"]
    assert runs[0].decision == "GO"


def test_repeated_keys_are_reported(spark, tmp_path):
    row = booking(4)
    run = small_run(spark, tmp_path, [row], [payment(1, row)] * 3, [*OFFERS, OFFERS[1]])
    found = {r["key"]: (r["repeated"], r["extra_rows"]) for r in k.repeated_keys(run.layers).collect()}
    assert found == {"offer_id": (1, 1), "payment_id": (1, 2)}


def test_every_json_record_can_be_held_to_the_contract(spark, tmp_path):
    row = booking(4)
    cut = payment(2, row)
    del cut["currency"]
    payments = [payment(1, row), cut]
    with pytest.raises(DataContractError, match="payments.jsonl lacks currency"):
        small_run(spark, tmp_path / "a", [row], payments, every_json_record=True)
    run = small_run(spark, tmp_path / "b", [row], payments)
    assert reasons(run) == {"T2": c.MISSING_REQUIRED}


def test_equal_versions_are_decided_by_row_number(spark, tmp_path):
    rows = [booking(4, client_id="one"), booking(4, client_id="two")]
    run = small_run(spark, tmp_path, rows, [payment(1, rows[0])])
    assert run.layers.silver_bookings.first()["client_id_hash"] == hashlib.sha256(b"two").hexdigest()
    assert run.layers.superseded.first()["dedup_rank"] == 2


def test_records_without_an_id_are_named_by_their_row(spark, tmp_path):
    rows = [booking(4), booking(8, booking_id="")]
    run = small_run(spark, tmp_path, rows, [payment(1, rows[0], payment_id="")])
    assert set(reasons(run)) == {"BOOKING_ROW_2", "PAYMENT_ROW_1", "R4"}
