import json
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from response_ledger.operators.audit import current_responses
from response_ledger.operators.fetch import Reply, fetch_requests, with_attempts
from response_ledger.operators.outcomes import classify, retry_queue, run_totals, to_ledger
from response_ledger.plans.job import (
    CallOptions,
    IncompleteRunError,
    run_stage,
    run_stages,
    settle,
    source_total,
)
from response_ledger.plans.requests import plan_ids, plan_pages
from response_ledger.schemas import ENDPOINTS
from response_ledger.session import scratch, scratch_root
from response_ledger.sources.ledger import append_ledger, read_ledger, target_path
from response_ledger.streaming.worksets import read_emitted, stream_workset
from response_ledger.table_ledgers import BASE_URL

IDS = [str(one) for one in range(31, 49, 3)]
QUICK = (0.015, 0.02, 0.02, 0.02)


class Service:
    """Six products behind a paged and a by-id endpoint; every call leaves a file in `log`."""

    def __init__(self, log, failing=(), flaky=(), broken=()):
        self.log, self.failing, self.flaky, self.broken = str(log), failing, dict(flaky), broken
        os.makedirs(self.log, exist_ok=True)

    def __call__(self):
        Path(self.log, f"connected-{time.time_ns()}-{os.getpid()}").touch()
        return Sender(self)

    def calls(self):
        names = [one.name for one in Path(self.log).iterdir() if one.name.startswith("call-")]
        return sorted(one.split("-")[1] for one in names)


class Sender:
    def __init__(self, service):
        self.service = service

    def close(self):
        Path(self.service.log, f"closed-{time.time_ns()}-{os.getpid()}").touch()

    def __call__(self, call):
        url, _, signature = call["url"].partition("?signature=")
        assert signature.isdigit()
        name = url.rsplit("/", 1)[-1] or "page"
        earlier = len([one for one in self.service.calls() if one == name])
        Path(self.service.log, f"call-{name}-{time.time_ns()}-{os.getpid()}").touch()
        if name in self.service.flaky and earlier < self.service.flaky[name][1]:
            trouble = self.service.flaky[name][0]
            if isinstance(trouble, Exception):
                raise trouble
            return Reply(trouble, b"busy")
        if name in self.service.broken:
            raise KeyError("not a transport error")
        if name in self.service.failing:
            return Reply(404, b"")
        if call["method"] == "POST":
            assert call["content_type"] == "application/x-www-form-urlencoded"
            asked = json.loads(call["body"].removeprefix("payload="))
            ids = IDS[asked["start"] - 1 : asked["start"] - 1 + asked["rows"]]
            result = [{"PRODUCTID": one} for one in ids]
            total = len(IDS)
        else:
            assert call["body"] is None and call["content_type"] is None
            result, total = {"COLUMNS": ["PRODUCTID"], "DATA": [[name]]}, 1
        answer = {"MESSAGE": "success", "RESULTCOUNT": total, "STATUSCODE": 400, "RESULT": result}
        return Reply(200, json.dumps(answer).encode(), "application/json", 4321 if name == "31" else None)


def options(service, **given):
    return CallOptions(service, BASE_URL, cooldown=(0.0, 0.0), pauses=QUICK, **given)


def paged(spark, tmp_path, rows=5, **given):
    calls = options(Service(tmp_path / "paged"))
    return run_stage(spark, "RECALLS", "r1", str(tmp_path), calls, ["productid"], rows=rows, **given)


def by_id(spark, tmp_path, service, **given):
    source = target_path(str(tmp_path), "RECALLS", "r1")
    return run_stage(
        spark, "PRODUCT", "r1", str(tmp_path), options(service), ["productid"], ids_source=source, **given
    )


def held(spark, tmp_path):
    rows = read_ledger(spark, target_path(str(tmp_path), "PRODUCT", "r1")).collect()
    return sorted(one["path_id"] for one in rows)


def test_paged_stage(spark, tmp_path):
    report = paged(spark, tmp_path, rows=3, batch_size=1)
    assert report == (2, 2, 0)
    directory = target_path(str(tmp_path), "RECALLS", "r1")
    rows = read_ledger(spark, directory).orderBy("start").collect()
    assert [(one["start"], one["rows"]) for one in rows] == [(1, 3), (4, 3)]
    found = [record["PRODUCTID"] for one in rows for record in json.loads(one["content"])["RESULT"]]
    assert found == IDS
    assert all(one["filters"] == [{"centercd": ["CBER", "CDER"]}] for one in rows)
    # One write per batch.
    assert len(list(Path(directory).rglob("*.parquet"))) == 2
    # The probe is called but not kept.
    assert len(Service(tmp_path / "paged").calls()) == 3


def test_paged_limit_counts_requests(spark, tmp_path):
    assert paged(spark, tmp_path, rows=3, limit=1).written == 1
    assert paged(spark, tmp_path, rows=3, limit=0) == (0, 0, 0)


def test_paged_stage_resumes_by_offsets(spark, tmp_path):
    def starts():
        found = read_ledger(spark, target_path(str(tmp_path), "RECALLS", "r1")).collect()
        return sorted((one["start"], one["rows"]) for one in found)

    assert paged(spark, tmp_path, rows=2, limit=1, resume_pages=True).written == 1
    assert paged(spark, tmp_path, rows=3, limit=1, resume_pages=True).written == 1
    # Offsets 1 to 3 are held by now, 5 and 6 are not, and 4 is in no page asked for.
    assert starts() == [(1, 2), (1, 3)]
    assert paged(spark, tmp_path, rows=2, batch_size=1, resume_pages=True) == (2, 2, 0)
    assert starts() == [(1, 2), (1, 3), (3, 2), (5, 2)]
    assert paged(spark, tmp_path, rows=4, resume_pages=True) == (0, 0, 0)
    # Other filters, and force, know of no page.
    assert paged(spark, tmp_path, rows=6, resume_pages=True, filters=[{"phase": ["x"]}]).written == 1
    assert paged(spark, tmp_path, rows=6, resume_pages=True, force=True).written == 1


def test_by_id_stage_resumes(spark, tmp_path):
    paged(spark, tmp_path)
    service = Service(tmp_path / "first")
    assert by_id(spark, tmp_path, service, limit=4) == (4, 1, 0)
    assert service.calls() == IDS[:4]
    service = Service(tmp_path / "second")
    assert by_id(spark, tmp_path, service) == (2, 1, 0)
    assert service.calls() == IDS[4:]
    assert held(spark, tmp_path) == [int(one) for one in IDS]
    service = Service(tmp_path / "third")
    assert by_id(spark, tmp_path, service) == (0, 0, 0)
    assert service.calls() == [] and held(spark, tmp_path) == [int(one) for one in IDS]


def test_force_appends_again(spark, tmp_path):
    paged(spark, tmp_path)
    by_id(spark, tmp_path, Service(tmp_path / "first"), limit=2)
    by_id(spark, tmp_path, Service(tmp_path / "second"), limit=2, force=True)
    assert held(spark, tmp_path) == [31, 31, 34, 34]


def test_a_failed_id_comes_back(spark, tmp_path):
    paged(spark, tmp_path)
    with pytest.raises(IncompleteRunError, match="PRODUCT: 1 calls without .*/40 "):
        by_id(spark, tmp_path, Service(tmp_path / "first", failing=("40",)), batch_size=2)
    assert held(spark, tmp_path) == [int(one) for one in IDS if one != "40"]
    letters = spark.read.parquet(target_path(str(tmp_path), "PRODUCT", "r1", "api_failures")).collect()
    assert [(one["path_id"], one["batch_no"], one["outcome"], one["failure"]) for one in letters] == [
        (40, 2, "terminal", "HTTP 404")
    ]
    service = Service(tmp_path / "second")
    assert by_id(spark, tmp_path, service) == (1, 1, 0)
    assert service.calls() == ["40"]
    assert held(spark, tmp_path) == [int(one) for one in IDS]


def test_a_batch_without_success_writes_nothing(spark, tmp_path):
    calls = options(Service(tmp_path / "log", failing=("producttypes",)))
    with pytest.raises(IncompleteRunError):
        run_stage(spark, "PRODUCT_TYPES", "r1", str(tmp_path), calls, [])
    assert not Path(target_path(str(tmp_path), "PRODUCT_TYPES", "r1")).exists()


def test_an_interrupted_run_keeps_its_batches(spark, tmp_path):
    paged(spark, tmp_path)
    whole = Service(tmp_path / "first")

    def connect():
        if len(whole.calls()) >= 3:
            raise SystemExit("machine lost")
        return whole()

    with pytest.raises(Exception, match="machine lost"):
        by_id(spark, tmp_path, connect, batch_size=3)
    assert held(spark, tmp_path) == [31, 34, 37]
    service = Service(tmp_path / "second")
    assert by_id(spark, tmp_path, service, batch_size=3) == (3, 1, 0)
    assert service.calls() == IDS[3:]


def test_sources_are_needed(spark, tmp_path):
    service = Service(tmp_path / "log")
    with pytest.raises(ValueError, match="ids_source"):
        run_stage(spark, "PRODUCT", "r1", str(tmp_path), options(service), [])
    with pytest.raises(FileNotFoundError):
        by_id(spark, tmp_path, service)
    assert service.calls() == []


def test_transient_failures_are_tried_again(spark, tmp_path):
    paged(spark, tmp_path)
    flaky = {
        "31": (503, 2), "34": (403, 2), "37": (429, 1),
        "40": (ConnectionRefusedError("refused"), 2), "43": (TimeoutError("slow"), 9),
    }
    service = Service(tmp_path / "log", flaky=flaky, broken=("46",))
    with pytest.raises(IncompleteRunError, match="PRODUCT: 2 calls"):
        by_id(spark, tmp_path, service)
    assert held(spark, tmp_path) == [31, 34, 37, 40]
    counts = {one: service.calls().count(one) for one in IDS}
    # Only transport errors and transient statuses are repeated, four tries at most.
    assert counts == {"31": 3, "34": 3, "37": 2, "40": 3, "43": 4, "46": 1}
    letters = spark.read.parquet(target_path(str(tmp_path), "PRODUCT", "r1", "api_failures")).collect()
    found = {one["path_id"]: (one["outcome"], one["attempts"], one["failure"]) for one in letters}
    assert found == {
        43: ("exhausted", 4, "transport: slow"),
        46: ("error", 1, "KeyError: 'not a transport error'"),
    }


def test_each_request_is_called_once_with_few_connections(spark, tmp_path):
    service = Service(tmp_path / "log")
    ids = spark.range(100, 140)
    requests = plan_ids(ids, BASE_URL, "PRODUCT", ["productid"]).withColumn("batch_no", F.lit(1))
    settled = settle(requests, options(service, max_workers=3))
    assert settled.totals == {"ok": 40} and settled.outcomes.count() == 40
    assert len(service.calls()) == 40
    names = [one.name.split("-")[0] for one in (tmp_path / "log").iterdir()]
    assert 1 <= names.count("connected") <= 3 and names.count("connected") == names.count("closed")


def test_call_records(spark, tmp_path):
    service = Service(tmp_path / "log")
    assert source_total(spark, options(service)) == 6
    requests = plan_ids(spark.range(31, 35, 3), BASE_URL, "PRODUCT", ["productid"])
    replies = fetch_requests(with_attempts(requests), service, 2, (0.0, 0.0))
    rows = {one["path_id"]: one for one in to_ledger(classify(replies)).collect()}
    import hashlib

    for one in rows.values():
        assert one["signature"].isdigit() and "signature" not in one["url"]
        assert one["sha_256"] == hashlib.sha256(one["content"].encode()).hexdigest()
        assert one["content_type"] == "application/json" and one["display_columns"] == ["productid"]
    # The length header is kept as it came, its absence made up for.
    assert rows[31]["content_length"] == 4321
    assert rows[34]["content_length"] == len(rows[34]["content"])


BODIES = {
    b'{"MESSAGE":"success"}': "ok",
    b' {"RESULT":[],"MESSAGE":"success","N":NaN}\n': "ok",
    b'{"MESSAGE":"page too long","STATUSCODE":417}': "api",
    b'{"STATUSCODE":417}': "api",
    b'{"MESSAGE":["success"]}': "api",
    b'{"MESSAGE":"success","RESULT":[1': "malformed",
    b'{"MESSAGE":"success"} x': "malformed",
    b'{"MESSAGE":"success"},{"MESSAGE":"success"}': "malformed",
    b"{'MESSAGE':'success'}": "malformed",
    b'[{"MESSAGE":"success"}]': "malformed",
    b"null": "malformed",
    b'{"MESSAGE":"success"},null': "malformed",
    b'null,{"MESSAGE":"success"}': "malformed",
    b'{"MESSAGE":"success"}],[': "malformed",
    b'{"MESSAGE":"success"},': "malformed",
    b'{"MESSAGE":"success"},{}]': "malformed",
    b'{"MESSAGE":"success"},{}] junk tail': "malformed",
    b'{"MESSAGE":"success"},{"body_digest":"0"}]': "malformed",
    b'{"MESSAGE":"success","body_digest":"0"}': "ok",
    b"": "malformed",
    b'{"MESSAGE":"success","X":"\xff"}': "undecodable",
    b'{"MESSAGE":"success","X":"\xed\xa0\x80"}': "undecodable",
}


def test_bodies_are_judged_whole(spark):
    requests = plan_ids(spark.range(len(BODIES)), BASE_URL, "EVENT", [])

    bodies = list(BODIES)

    def connect():
        return lambda call: Reply(200, bodies[int(call["url"].split("?")[0].rsplit("/", 1)[-1])])

    replies = fetch_requests(with_attempts(requests), connect, 2, (0.0, 0.0))
    judged = {one["path_id"]: one["outcome"] for one in classify(replies).collect()}
    assert [judged[place] for place in range(len(bodies))] == list(BODIES.values())


def test_large_replies_are_handed_over_in_pieces(spark, monkeypatch):
    monkeypatch.setattr("response_ledger.operators.fetch._FLUSH_BYTES", 1000)
    requests = plan_ids(spark.range(100), BASE_URL, "EVENT", [])

    def connect():
        return lambda call: Reply(200, b'{"MESSAGE":"success","X":"' + b"x" * 700 + b'"}')

    replies = fetch_requests(with_attempts(requests), connect, 3, (0.0, 0.0))
    judged = classify(replies).select("path_id", "outcome", "url").collect()
    assert sorted(one["path_id"] for one in judged) == list(range(100))
    assert all(one["outcome"] == "ok" and one["url"].endswith(f"/{one['path_id']}") for one in judged)


def test_a_due_time_is_waited_for(spark):
    requests = plan_ids(spark.range(1), BASE_URL, "EVENT", []).withColumn("batch_no", F.lit(1))
    busy = fetch_requests(with_attempts(requests), lambda: lambda call: Reply(503, b""), 1, (0.0, 0.0))
    queue = retry_queue(classify(busy))
    again = fetch_requests(queue, lambda: lambda call: Reply(200, b"{}"), 1, (0.0, 0.0)).collect()
    assert again[0]["attempts"] == 1
    # Whoever recomputes the queue finds the same due time.
    landed = classify(busy).select("*").collect()
    frozen = spark.createDataFrame(landed, classify(busy).schema)
    first, second = (retry_queue(frozen).collect() for _ in range(2))
    assert first == second
    pause = (first[0]["next_attempt_at"] - landed[0]["fetched_at"]).total_seconds()
    assert 1.5 <= pause < 2.5
    assert again[0]["fetched_at"] >= again[0]["next_attempt_at"]


def test_totals_name_the_first_failure(spark):
    requests = plan_pages(spark, BASE_URL, 7500, ["productid"], 2500).withColumn("batch_no", F.lit(1))

    def connect():
        def send(call):
            start = json.loads(call["body"].removeprefix("payload="))["start"]
            return Reply(200, json.dumps({"MESSAGE": "boom" if start == 2501 else "success"}).encode())

        return send

    judged = classify(fetch_requests(with_attempts(requests), connect, 2, (0.0, 0.0)))
    totals = run_totals(judged).first()
    assert (totals["written"], totals["failed"], totals["batches"]) == (2, 1, 1)
    assert totals["first_failure"]["start"] == 2501


def test_all_stages_in_order(spark, tmp_path):
    service = Service(tmp_path / "log")
    stages = ("RECALLS", "PRODUCT_TYPES", "PRODUCT", "CODE_INFO")
    columns = {one: ["productid"] for one in ENDPOINTS}
    reports = run_stages(spark, "r1", str(tmp_path), options(service), columns, stages)
    assert list(reports) == list(stages)
    assert [one.written for one in reports.values()] == [1, 1, 6, 6]
    again = run_stages(spark, "r1", str(tmp_path), options(service), columns, stages)
    # Endpoints without ids are fetched whole each time, the others resume.
    assert [one.written for one in again.values()] == [1, 1, 0, 0]
    forced = run_stages(spark, "r1", str(tmp_path), options(service), columns, stages, force=True)
    assert [one.written for one in forced.values()] == [1, 1, 6, 6]


def test_by_id_stages_need_the_paged_run(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_stages(spark, "r1", str(tmp_path), options(Service(tmp_path / "log")), {}, ("PRODUCT",))


def test_plans_of_many_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("response_ledger.plans.job.CHUNK_BATCHES", 2)
    paged(spark, tmp_path)
    service = Service(tmp_path / "first")
    assert by_id(spark, tmp_path, service, batch_size=1) == (6, 6, 0)
    assert service.calls() == IDS and held(spark, tmp_path) == [int(one) for one in IDS]


def test_a_limit_takes_the_first_ids_and_says_so(spark, tmp_path, caplog):
    paged(spark, tmp_path)
    service = Service(tmp_path / "first")
    assert by_id(spark, tmp_path, service, limit=4, batch_size=3) == (4, 2, 0)
    assert service.calls() == IDS[:4] and "first 4 ids" in caplog.text
    caplog.clear()
    assert by_id(spark, tmp_path, service, limit=2) == (2, 1, 0) and not caplog.text
    calls = options(service)
    assert run_stage(spark, "PRODUCT_TYPES", "r1", str(tmp_path), calls, [], limit=0) == (0, 0, 0)
    assert "not made" in caplog.text


class ClientTimeout(Exception):
    """A client's own class, which is no OSError."""


def test_errors_of_a_clients_own_are_tried_again_if_named(spark, tmp_path):
    paged(spark, tmp_path)
    flaky = {"31": (ClientTimeout("read"), 2), "34": (ClientTimeout("read"), 9)}
    service = Service(tmp_path / "first", flaky=flaky)
    source = target_path(str(tmp_path), "RECALLS", "r1")
    calls = options(service, transient=lambda error: isinstance(error, ClientTimeout))
    with pytest.raises(IncompleteRunError, match="PRODUCT: 1 calls"):
        run_stage(spark, "PRODUCT", "r1", str(tmp_path), calls, [], ids_source=source)
    assert held(spark, tmp_path) == [int(one) for one in IDS if one != "34"]
    assert service.calls().count("31") == 3 and service.calls().count("34") == 4


def test_a_connection_that_fails_is_tried_again(spark, tmp_path):
    paged(spark, tmp_path)
    whole, mark = Service(tmp_path / "first"), tmp_path / "refused"

    def connect():
        if not mark.exists():
            mark.touch()
            raise ConnectionRefusedError("not yet")
        return whole()

    assert by_id(spark, tmp_path, connect) == (6, 1, 0)
    with pytest.raises(IncompleteRunError, match="PRODUCT: 6 calls"):
        by_id(spark, tmp_path, lambda: {}["no such transport"], force=True)


def test_scratch_tables_go_with_a_run(spark, tmp_path):
    folder = Path(scratch_root(spark))
    before = {one.name for one in folder.iterdir()}
    paged(spark, tmp_path)
    with pytest.raises(IncompleteRunError):
        by_id(spark, tmp_path, Service(tmp_path / "log", failing=("40",)))
    with pytest.raises(Exception, match="machine lost"):
        by_id(spark, tmp_path, lambda: (_ for _ in ()).throw(SystemExit("machine lost")), force=True)
    columns = {"PRODUCT": ["productid"]}
    run_stages(spark, "r1", str(tmp_path), options(Service(tmp_path / "log")), columns, ("PRODUCT",), force=True)
    with scratch(spark):
        found = current_responses(read_ledger(spark, target_path(str(tmp_path), "PRODUCT", "r1")))
        assert found.count() == 6
    assert {one.name for one in folder.iterdir()} == before


def test_stream_emits_each_new_id_once(spark, tmp_path):
    pages, target = str(tmp_path / "pages"), str(tmp_path / "target")

    def land(*ids):
        from tests.test_ledgers import body, pages as rows

        append_ledger(rows(spark, body([{"PRODUCTID": str(one)} for one in ids])), pages)

    assert read_emitted(spark, str(tmp_path / "ids")).count() == 0

    def run(state="state", source=pages):
        stream_workset(
            spark, source, target, "PRODUCT", str(tmp_path / "ids"), str(tmp_path / state), 1
        ).awaitTermination()
        return sorted(one["id"] for one in read_emitted(spark, str(tmp_path / "ids")).collect())

    from tests.test_ledgers import row
    from response_ledger.schemas import LEDGER

    land(1, 2, 2, 3)
    land(3, 4)
    append_ledger(spark.createDataFrame([row("PRODUCT", "{}", path_id=4)], LEDGER), target)
    assert run() == [1, 2, 3]
    land(2, 4, 5)
    assert run() == [1, 2, 3, 5]
    assert run() == [1, 2, 3, 5]
    # A micro-batch whose end was never recorded is run again and emits the same once.
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda one: int(one.name))
    for one in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        one.unlink(missing_ok=True)
    assert run() == [1, 2, 3, 5]
    # A new checkpoint, over the same and over another source, loses and repeats nothing.
    assert run("second") == [1, 2, 3, 5]
    pages = str(tmp_path / "more")
    land(5, 6)
    assert run("third", pages) == [1, 2, 3, 5, 6]


def test_python_is_handed_what_a_call_is_made_of(spark, tmp_path):
    requests = with_attempts(plan_pages(spark, BASE_URL, 10, ["productid"], 5))
    replies = fetch_requests(requests, lambda: lambda call: Reply(200, call["body"].encode()), 2, (0.0, 0.0))
    # Lists and maps of a request stay where they are.
    plan = replies._jdf.queryExecution().optimizedPlan().toString()
    handed = [line for line in plan.splitlines() if "fetch(" in line]
    assert handed and not any("display_columns" in line.split("fetch(")[1].split(")")[0] for line in handed)
    assert "MapInArrow" not in plan
    rows = replies.orderBy("start").collect()
    assert [one["raw"].decode() for one in rows] == [one["body"] for one in rows]
    assert all(one["display_columns"] == ["productid"] and one["filters"] for one in rows)


def test_calls_are_made_if_nothing_asks_for_the_replies(spark, tmp_path):
    service = Service(tmp_path / "log")
    requests = plan_ids(spark.range(31, 40, 3), BASE_URL, "PRODUCT", ["productid"])
    assert fetch_requests(with_attempts(requests), service, 2, (0.0, 0.0)).select("path_id").count() == 3
    assert service.calls() == IDS[:3]


def test_all_tasks_judge_what_few_have_called(spark, tmp_path, monkeypatch):
    from response_ledger.plans import job

    classify, seen = job.classify, []

    def noted(replies, pauses):
        seen.append(replies._jdf.queryExecution().optimizedPlan().toString())
        return classify(replies, pauses)

    monkeypatch.setattr(job, "classify", noted)
    requests = plan_ids(spark.range(100, 140), BASE_URL, "PRODUCT", ["productid"]).withColumn("batch_no", F.lit(1))
    settled = settle(requests, options(Service(tmp_path / "log"), max_workers=3))
    assert settled.totals == {"ok": 40}
    # The replies judged are landed ones, not those of a call under way.
    assert len(seen) == 1 and "fetch(" not in seen[0]
