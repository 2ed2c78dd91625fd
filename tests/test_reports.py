"""Replies (S2), dedup ties (D2, D3), reports (K1, K2) and sinks."""

import json
import os
import shutil
import tempfile

from pyspark.sql import functions as F

from newsfold.operators.dedup import dedupe_pages, url_dedup
from newsfold.operators.replies import parse_replies

BODY = "\n".join(
    [
        "intro 1. **ignored**",
        "## Search Results",
        "1. **First** title**",
        "   URL: https://a.example/1",
        "(google) first snippet",
        "2. **No snippet**",
        "   URL: https://a.example/2",
        "3. **Paren first**",
        "(google) too early",
        "   URL: https://a.example/3",
        "4. **Fourth**",
        "   URL: https://a.example/4a",
        "continuation line",
        "   URL: https://a.example/4b",
        "(bing) fourth snippet",
        "   URL: https://a.example/ignored",
    ]
)


def test_parse_replies(spark):
    df = spark.createDataFrame([(1, BODY)], "response_id int, body string")
    got = [(r["item_no"], r["title"], r["url"], r["snippet"]) for r in parse_replies(df).orderBy("item_no").collect()]
    assert got == [
        (1, "First", "https://a.example/1", "(google) first snippet"),
        (4, "Fourth", "https://a.example/4b", "(bing) fourth snippet"),
    ]


RES_SCHEMA = (
    "run_id string, task_name string, arrival_seq long, url string, normalized_url string, title string, "
    "snippet string, domain string, content string, content_chars int, fetch_status string, fetched_at string, domain_score int"
)


def res(seq, url, title, score, chars):
    return ("r", "t", seq, url, url, title, "", "d", "x" * chars, chars, "ok", "ts", score)


def test_url_dedup_keeps_best_at_first_position(spark):
    rows = [res(1, "u1", "Alpha story one", 0, 10), res(2, "u1", "Alpha story two", 0, 20), res(3, "u2", "Beta", 0, 5), res(4, "u2", "Beta b", 0, 5)]
    d2 = {r["normalized_url"]: (r["arrival_seq"], r["first_seen"]) for r in url_dedup(spark.createDataFrame(rows, RES_SCHEMA)).collect()}
    assert d2 == {"u1": (2, 1), "u2": (3, 3)}


def test_title_dedup(spark):
    rows = [
        res(1, "a", "Same Title Here", 0, 10),
        res(2, "b", "Same Title Here", 2, 5),  # higher domain score wins
        res(3, "c", "Tie Title Words", 0, 7),
        res(4, "d", "Tie Title Words", 0, 7),  # tie keeps the smaller first_seen
        res(5, "e", "Новая модель", 0, 7),  # empty key: dropped
    ]
    d3 = {r["normalized_url"] for r in dedupe_pages(spark.createDataFrame(rows, RES_SCHEMA)).collect()}
    assert d3 == {"b", "c"}
    uni = {r["normalized_url"] for r in dedupe_pages(spark.createDataFrame(rows, RES_SCHEMA), mode="unicode").collect()}
    assert uni == {"b", "c", "e"}


def test_empty_input_reports_keep_header(spark):
    from newsfold.plans.triage import run_triage
    from newsfold.sources.tasks import PROSE_CONFIG

    empty = spark.createDataFrame([], "page_id long, url string, html string")
    result = run_triage(spark, empty, PROSE_CONFIG)
    assert result.ranked.count() == 0
    md = result.markdown_rows.collect()
    assert sorted(r["task_name"] for r in md) == ["prose_en", "prose_mixed"]
    assert all(r["text"].startswith("# Daily Report: ") for r in md)


def text_of(out, kind, task, run_id):
    folder = os.path.join(out, kind, f"task_name={task}", f"run_id={run_id}")
    return "".join(open(os.path.join(folder, f)).read() for f in sorted(os.listdir(folder)) if f.startswith("part-"))


def test_json_document_of_a_cluster_over_several_queries(spark):
    """Sources of one cluster come from three queries; a task without clusters has a document too."""
    from newsfold.operators import clusters as C
    from newsfold.operators import report as RP
    from newsfold.operators.features import page_features
    from newsfold.operators.leader import leader_labels
    from newsfold.sources import sinks

    rows = [res((q << 32) + 1, f"u{q}", f"Same \"story\" retold {w}", 0, 10 + q) for q, w in enumerate(("alpha", "beta", "gamma"))]
    rows.append(res(7, "other", "Unrelated words entirely", 0, 3))
    f = page_features(spark.createDataFrame(rows, RES_SCHEMA).withColumns({"seq": F.col("arrival_seq"), "content": F.lit("one shared body of text")})).checkpoint()
    members = C.assign(f, leader_labels(f))
    ranked = C.rank(C.summarize(members), cap=10)
    names = spark.createDataFrame([("r", "t"), ("r", "idle")], "run_id string, task_name string")
    out = tempfile.mkdtemp(prefix="newsfold-json-")
    blocks = RP.json_blocks(ranked, C.sources(members, ranked), names, "2024-02-15T00:00:00+00:00")
    sinks.write_json_report(blocks, out + "/json")
    doc = json.loads(text_of(out, "json", "t", "r"))
    sizes = {c["source_count"]: [s["url"] for s in c["sources"]] for c in doc["clusters"]}
    assert sum(sizes) == 4 and all(n == len(v) for n, v in sizes.items())
    assert max(sizes) >= 3 and {"u0", "u1", "u2"} <= set(sizes[max(sizes)])
    assert json.loads(text_of(out, "json", "idle", "r")) == {"task_name": "idle", "generated_at": "2024-02-15T00:00:00+00:00", "total_clusters": 0, "clusters": []}


def test_runs_have_their_own_identity():
    from newsfold.sources.tasks import TaskConfig

    a, b = TaskConfig(()), TaskConfig(())
    assert a.run_id != b.run_id and a.run_ts[-6] in "+-"


def test_config_reader(spark):
    from newsfold.sources.tasks import PROSE_CONFIG, Query, Task, read_config

    folder = tempfile.mkdtemp(prefix="newsfold-config-")
    with open(f"{folder}/tasks.json", "w") as f:
        for t in PROSE_CONFIG.tasks:
            qs = [{"text": q.text, "alternatives": q.alternatives, "exclude_hosts": q.exclude_hosts, "primary_fails": q.primary_fails} for q in t.queries]
            f.write(json.dumps({"name": t.name, "top_k": t.top_k, "final_event_cap": t.final_event_cap, "max_content_chars": t.max_content_chars, "queries": qs}) + "\n")
        f.write(json.dumps({"name": "z_defaults", "queries": [{"text": "x", "alternatives": [[["x"]]]}]}) + "\n")
    cfg = read_config(spark, folder, run_id="r1", blocked_host_tokens=("a",))
    tasks = lambda c: [(t.name, t.top_k, t.final_event_cap, t.max_content_chars, [(q.text, json.dumps(q.alternatives), q.exclude_hosts, q.primary_fails) for q in t.queries]) for t in c.tasks]
    assert tasks(cfg)[:2] == tasks(PROSE_CONFIG) and cfg.run_id == "r1"
    assert cfg.tasks[2] == Task("z_defaults", (Query("x", ((("x",),),)),))


def test_triage_sinks_and_markdown_shape(spark):
    from newsfold.plans.triage import run_triage
    from newsfold.sources import sinks, tables
    from newsfold.sources.tasks import PROSE_CONFIG

    result = run_triage(spark, tables.pages(spark, "/root/testdata/sf0.001"), PROSE_CONFIG)
    out = tempfile.mkdtemp(prefix="newsfold-sink-")
    sinks.write_json_report(result.json_blocks, out + "/json")
    sinks.write_markdown_report(result.markdown_rows, out + "/md")
    doc = json.loads(text_of(out, "json", "prose_en", PROSE_CONFIG.run_id))
    assert doc["task_name"] == "prose_en" and doc["generated_at"] == PROSE_CONFIG.run_ts
    assert doc["total_clusters"] == len(doc["clusters"]) > 0
    assert [c["id"] for c in doc["clusters"]] == list(range(1, len(doc["clusters"]) + 1))
    assert all(len(c["sources"]) == c["source_count"] for c in doc["clusters"])
    text = text_of(out, "md", "prose_en", PROSE_CONFIG.run_id)
    assert text.startswith("# Daily Report: prose_en\nGenerated: ")
    assert "## 1. " in text and "### Content Preview" in text and "---" in text


def test_snapshot_stream_runs_once(spark):
    from newsfold.sources.tasks import PROSE_CONFIG
    from newsfold.streaming.snapshots import start_snapshot_runs

    snap = tempfile.mkdtemp(prefix="newsfold-snap-")
    shutil.copy("/root/testdata/sf0.001/pages.parquet", os.path.join(snap, "pages-0001.parquet"))
    shutil.copy("/root/testdata/sf0.001/pages.parquet", os.path.join(snap, "pages-0002.parquet"))
    out = tempfile.mkdtemp(prefix="newsfold-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="newsfold-stream-ckpt-")
    q = start_snapshot_runs(spark, snap, PROSE_CONFIG, out, checkpoint_location=ckpt)
    q.awaitTermination(600)
    stages = spark.read.parquet(out + "/stages/clusters")
    assert stages.count() > 0
    assert {r["run_id"] for r in stages.select("run_id").distinct().collect()} == {"snapshots_b0", "snapshots_b1"}


def test_sink_overwrites_only_its_run(spark):
    from newsfold.sources import sinks

    out = tempfile.mkdtemp(prefix="newsfold-sink2-") + "/md"
    rows = lambda run: spark.createDataFrame(
        [("t", run, 0, 0, 0, f"# {run}\n")], "task_name string, run_id string, cluster_id int, part int, seq long, text string"
    )
    sinks.write_markdown_report(rows("r1"), out)
    sinks.write_markdown_report(rows("r2"), out)
    sinks.write_markdown_report(rows("r2"), out)  # a retried run replaces itself
    got = sorted((r["run_id"], r["value"]) for r in spark.read.text(out).collect() if r["value"])
    assert got == [("r1", "# r1"), ("r2", "# r2")]
