"""Transfers: plans against plain loops, real files fetched in ranges, resumed and checked."""

import hashlib
import random

from lexmill.operators import transfers


def test_parts_resume(spark):
    files = spark.createDataFrame([("a", 100), ("b", 0), ("c", None), ("d", 9)], "path string, size bigint")
    disk = spark.createDataFrame([("a", 0, 25), ("a", 0, 3), ("a", 1, 7), ("a", 2, 99), ("c", 0, 5), ("zz", 0, 1)], "path string, part int, have bigint")
    got = {(r.path, r.part): (r.first, r.last, r.state, r.start) for r in transfers.part_plan(files, disk, 4, 10).collect()}
    assert got == {("a", 0): (0, 24, "complete", None), ("a", 1): (25, 49, "partial", 32), ("a", 2): (50, 74, "oversize", 50), ("a", 3): (75, 99, "missing", 75), ("c", 0): (0, None, "oversize", 0), ("d", 0): (0, 8, "missing", 0)}
    assert transfers.part_plan(files.limit(0), disk).count() == 0


def test_downloads_in_ranges(spark, tmp_path):
    rng = random.Random(2)
    data = {n: bytes(rng.randrange(256) for _ in range(size)) for n, size in (("one", 5000), ("two", 3), ("empty", 0), ("bad", 400), ("there", 50))}
    for n, content in data.items():
        (tmp_path / f"src-{n}").write_bytes(content)
    (tmp_path / "there").write_bytes(data["there"])
    (tmp_path / "one.part0").write_bytes(data["one"][:100])  # left by a run that broke off
    (tmp_path / "one.part1").write_bytes(b"x" * 9999)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    rows = [(f"{tmp_path}/{n}", f"{tmp_path}/src-{n}", len(c), sha(c).upper() if n != "bad" else sha(b"other")) for n, c in data.items()]
    rows += [(f"{tmp_path}/gone", f"{tmp_path}/src-gone", 5, None), (f"{tmp_path}/unknown", f"{tmp_path}/src-one", None, None)]
    files = spark.createDataFrame(rows, "path string, source string, size bigint, sha256 string")
    got = {r.path.rsplit("/", 1)[1]: (r.outcome, r.error is None) for r in transfers.download(files, parts=3, least=1000).collect()}
    assert got == {"one": ("done", True), "two": ("done", True), "empty": ("done", True), "there": ("done", True), "unknown": ("done", True), "bad": ("wrong digest", True), "gone": ("missing", False)}
    assert all((tmp_path / n).read_bytes() == data[n] for n in ("one", "two", "empty", "there")) and (tmp_path / "unknown").read_bytes() == data["one"]
    assert not (tmp_path / "bad").exists() and not list(tmp_path.glob("one.part*"))


def test_upload_steps(spark):
    files = [("a", 5, 5, "x", 5, "x"), ("b", 5, None, "x", 5, None), ("c", 5, 5, "x", 5, "y"), ("d", 5, 5, "x", None, None), ("e", 5, 4, "x", None, None), ("f", None, 5, "x", 5, "x"), ("g", 5, None, "x", 6, "x")]
    df = spark.createDataFrame(files, "path string, expected int, local int, sha256 string, hub_size int, hub_sha256 string")
    assert {r.path: r.step for r in transfers.upload_plan(df).collect()} == {"a": "clear", "b": "done", "c": "upload", "d": "upload", "e": "fetch", "f": "wait", "g": "fetch"}


def test_job_costs(spark):
    events = spark.createDataFrame([("j", "big", "running", None, 1), ("j", "big", "done", 1800.0, 2), ("k", "odd", "done", 10.0, 1), ("l", "big", "running", None, 1)], "job_id string, flavor string, status string, seconds double, at int")
    rates = spark.createDataFrame([("big", 2.0)], "flavor string, hourly double")
    assert {r.job_id: (r.status, r.cost) for r in transfers.job_ledger(events, rates).collect()} == {"j": ("done", 1.0), "k": ("done", None), "l": ("running", None)}


def test_throttled_engine_waits_retries_and_stops(spark):
    from lexmill.providers.registry import ServiceError, Throttled

    now, slept, answers = [0.0], [], []

    def sleep(s):
        slept.append(round(s, 3))
        now[0] += s

    def call(row):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a, 1

    engine = Throttled(call, per_second=2.0, attempts=3, clock=lambda: now[0], sleep=sleep)
    answers[:] = ["a", "b"]
    assert [engine({})[0], engine({})[0]] == ["a", "b"] and slept == [0.5]
    answers[:] = [ServiceError(429, wait=7.0), ServiceError(503), "c"]
    assert engine({})[0] == "c" and slept[-2:] == [7.0, 2.0] and len(engine.notes) == 2
    for error in (ServiceError(404), ValueError("x")):  # no use trying again
        answers[:] = [error]
        try:
            raise AssertionError(engine({}))
        except type(error):
            assert not answers
    answers[:] = [ServiceError(500)] * 3 + [ServiceError(400, "Your credit balance is too low"), "never"]
    for left in (2, 1, 1):
        try:
            raise AssertionError(engine({}))
        except ServiceError:
            assert len(answers) == left
