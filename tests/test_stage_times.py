"""Stage times read back from an event log."""

import json

from delaylake.plans import stage_times as ST


def events():
    task = lambda stage, ms, read, ok=True: {
        "Event": "SparkListenerTaskEnd", "Stage ID": stage, "Task End Reason": {"Reason": "Success" if ok else "ExecutorLost"},
        "Task Metrics": {"Executor Run Time": ms, "Disk Bytes Spilled": 5, "Input Metrics": {"Bytes Read": read},
                         "Output Metrics": {"Bytes Written": 2_000_000}, "Shuffle Write Metrics": {"Shuffle Bytes Written": 7},
                         "Shuffle Read Metrics": {"Remote Bytes Read": 1, "Local Bytes Read": 2}}}
    done = lambda stage, a, b: {"Event": "SparkListenerStageCompleted", "Stage Info": {
        "Stage ID": stage, "Stage Name": "s", "Submission Time": a, "Completion Time": b}}
    skipped = {"Event": "SparkListenerStageCompleted", "Stage Info": {"Stage ID": 9, "Stage Name": "s"}}
    lost = {"Event": "SparkListenerTaskEnd", "Stage ID": 1, "Task End Reason": {"Reason": "ExecutorLost"}}
    return [task(1, 1500, 3_000_000), task(1, 500, 1_000_000, False), lost, done(1, 10_000, 12_500),
            task(2, 250, 0), done(2, 20_000, 20_300), skipped]


def test_stages_and_spans():
    lines = [json.dumps(e) for e in events()] + ['{"Event": "SparkListenerTas']
    found = ST.stages(lines)
    assert [r["stage"] for r in found] == [1, 2]
    one = found[0]
    assert (one["tasks"], one["failed_tasks"], one["task_seconds"], one["longest_task"], one["seconds"]) == (3, 2, 2.0, 1.5, 2.5)
    spans = ST.by_span(found, {"a": (9.0, 15.0), "b": (15.0, 30.0), "none": (40.0, 50.0)})
    assert spans["a"]["input_mb"] == 4.0 and spans["a"]["output_mb"] == 4.0 and spans["a"]["stages"] == 1
    assert spans["b"] == {"stages": 1, "tasks": 1, "task_sec": 0.25, "longest_stage_sec": 0.3, "longest_task_sec": 0.25,
                          "input_mb": 0.0, "output_mb": 2.0, "shuffle_write_mb": 0.0, "spill_mb": 0.0}
    assert spans["none"]["stages"] == 0 and spans["none"]["longest_stage_sec"] == 0.0
