"""What queries over project files cost besides their rows: the size of their plans, and one pass over a file."""

import random

import pytest

from seqloom.plans import catalogue, corpus, file_queries, lint, rewrite
from seqloom.sources import projects
from seqloom.sources.projects import Projects

DIR = "/root/testdata/sf0.001"
#: Most operators a plan may have, so that planning takes seconds.
MOST = 400


@pytest.mark.parametrize("name", ["q_contract_midi", "q_corpus_midi", "q_file_lint", "q_file_lint_status", "q_file_worklist", "q_rewrite_reread"])
def test_plan_size(spark, name):
    plan = catalogue.QUERIES[name](spark, DIR)._jdf.queryExecution().optimizedPlan()
    assert (n := plan.treeString().count("\n")) < MOST, n


ODD = [
    "<REAPER_PROJECT", "E 0 90 3c 64", "NAME early", "TEMPO 120 4 4 0", "<TEMPOENVEX", "PT 0 100 1", "<TRACK inside", ">", "<TRACK", "E 1 90 3c 64", " e  2\t90 3C 40 ", "ENV a", "E 3 80 3c 00", "ENV", "ENV", "E 4 80 3c 00",
    "E 5 91 3c 10", "E 1 80 3c 00", "E 2 91 3c 00 ", "E x", "E 9 b0 06 0c", "E 1 e0 00 40", "<VST \"VST3i: Ample Sound\" a", "E 1 90 40 40", ">", "E 0 b0 65 00", "E 0 b0 64 00", "E 0 b1 06 0c", "E 0 b0 06 0c", "E 0 e0 1 1", "E 0 e0 00 41", "E 1 e1 00 00", "E 1 90 40 40",
    "<TRACK ", "<VST \"x\" Ample Sound", "E 1 90 41 40", "E 0 80 41 00", "E 0 90 41 00", "<TRACKS", "E 1 90 41 00 7", "E 12 90 42 7f", "E 0 90 42 01", "E 0 90 42 00", "E 6 80 42 00", ">",
]

#: What the reader by windows over lines, which this one replaced, found.
NOTES = [(2, 0, 1, 6, 60, 100, 0), (2, 1, 9, 12, 60, 16, 1), (3, 0, 1, 2, 65, 64, 0), (3, 1, 12, 13, 66, 127, 0), (3, 2, 12, 18, 66, 1, 0)]
RUNS = [(2, 1, 6, 3), (2, 2, 12, 4), (2, 3, 10, 2), (2, 4, 0, 4), (2, 5, 2, 3), (3, 6, 1, 3), (3, 7, 18, 4)]
AUDITS = [(2, 5, 3, 3), (3, 0, 0, 0)]
TRACKS = [(1, 0, 0, []), (2, 2, 12, ['Ample Sound']), (3, 3, 18, ['x'])]
MALFORMED = ['E x', 'E 0 e0 1 1', 'E 1 90 41 00 7']


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
def test_one_pass_over_odd_lines(spark, newline):
    p = Projects(spark.createDataFrame([("/p/a.RPP", bytearray(newline.join(ODD).encode() + b"\xff\xe2\x80")), ("/p/empty.RPP", bytearray()), ("/p/none.RPP", None)], "path string, content binary"))
    assert [tuple(r) for r in p.notes.select("track", "note_ix", "start", "end", "pitch", "velocity", "channel").orderBy("track", "note_ix").collect()] == NOTES
    assert [tuple(r) for r in p.events.groupBy("track", "run").agg({"tick": "max", "ln": "count"}).select("track", "run", "max(tick)", "count(ln)").orderBy("track", "run").collect()] == RUNS
    assert [tuple(r) for r in p.audits.select("track", "source_cc_count", "bend_count", "bends_missing_rpn").orderBy("track").collect()] == AUDITS
    assert [tuple(r) for r in p.tracks.select("track", "note_count", "last_tick", "instrument_plugins").orderBy("track").collect()] == TRACKS
    assert [r.line for r in p.malformed.orderBy("ln").collect()] == MALFORMED
    assert {r.path for r in p.read.select("path").collect()} == {"/p/a.RPP", "/p/empty.RPP"}


def test_plain_events_are_read_in_stretches(monkeypatch):
    """No pattern sees an event line in the plain form; ticks and notes are those of the same lines in another form, read one by one."""
    r, waiting = random.Random(4), "<TRACK\n"
    for _ in range(400):
        waiting += r.choice(["E {} 90 3c 40\n", "E {} 80 3c 00\n", "E {} 91 3C 40\n", "E {} 81 3c 00\n", "ENV\n", "E {} 90 3d 00\n", "<TRACK\n>\n"]).format(r.randrange(400))
    odd = waiting.replace("E ", "E  ")
    want, lines = projects.tracks_in(odd, {}), [own for own, _ in projects.tracks_in(waiting, {})]
    on, off = projects.notes_of(projects.scanned(odd.encode(), {})[1])

    class Unused:
        def match(self, line):
            assert line[1:2] != " ", line  # ENV lines only

    monkeypatch.setattr(projects, "_EVENT", Unused())
    assert [e for _, e in projects.tracks_in(waiting, {})] == [e for _, e in want] and lines == [own for own, _ in want]
    a, b = projects.notes_of(projects.scanned(waiting.encode(), {})[1])
    assert a.tolist() == on.tolist() and b.tolist() == off.tolist()
    flat = [e for _, own in want for e in own]
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == sorted(n[5:] for n in projects.paired(flat))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_notes_are_dealt_once_and_never_broadcast(spark):
    p = file_queries.projects(spark, DIR)
    midi = plan_of(corpus.corpus_midi(p))
    assert "Window" not in midi and "SortMergeJoin" in midi
    found = plan_of(lint.gesture_findings(p, p.parts(), ["gestures"]))
    assert "SortMergeJoin" in found and "start_s" not in "".join(x for x in found.split("\n") if "Exchange" in x)


def test_reread_keeps_notes_in_their_rows(spark):
    p = file_queries.projects(spark, DIR)
    plans = rewrite.plan(p).where("content IS NOT NULL").select("path", "content")
    plan = plan_of(rewrite.reread(p, Projects(file_queries.held(plans))))
    assert not [x for x in plan.split("\n") if "Generate posexplode(arrays_zip" in x]


def test_files_are_written_in_stretches(spark):
    """Rows are put in order by supplier alone: no lists of lines are built and sorted by Spark; a headers' table is worked out once for tempo."""
    plan = plan_of(file_queries.project_text(spark, DIR))
    assert "collect_list" not in plan and "MapInArrow" in plan
    p = Projects(file_queries.project_text(spark, DIR).select("path", "content"))
    assert str(p.tempo._jdf.queryExecution().optimizedPlan()).count("MapInArrow _files") <= 3  # headers, and the envelopes' heads and points


def test_rows_of_files_share_batches():
    import pyarrow as pa

    text = "\n".join(ODD)
    batch = pa.record_batch([pa.array([f"/p/{i}.RPP" for i in range(40)]), pa.array([text] * 40)], ["path", "text"])
    found = list(projects._track_rows(iter([batch])))
    alone = [next(projects._track_rows(iter([batch.slice(i, 1)]))) for i in range(40)]
    assert len(found) == 1 and found[0].to_pylist() == [r for b in alone for r in b.to_pylist()]


def test_files_are_read_together(monkeypatch):
    """What is worked out of a stretch of files at once is what each gives by itself, whatever their newlines, odd lines and ends."""
    import pyarrow as pa

    r, calls = random.Random(7), []
    plain = ["E 1 90 3c 64", "E 2 80 3c 00", "E 3 91 40 01", "E 0 81 40 00"]
    texts = [r.choice(["\n", "\r\n", "\r"]).join(r.choice(plain if r.random() < 0.5 else ODD) for _ in range(r.choice([0, 1, 3, 40]))) + r.choice(["", "\n"]) for _ in range(60)]
    scan = projects.scanned_files
    monkeypatch.setattr(projects, "scanned_files", lambda *a: calls.append(len(a[0])) or scan(*a))
    rows = lambda of: [x for t in projects._track_rows(iter([pa.record_batch([pa.array([f"/p/{i}.RPP" for i, _ in of]), pa.array([t for _, t in of])], ["path", "text"])])) for x in t.to_pylist()]
    together = rows([*enumerate(texts)])
    assert calls == [60]
    assert together == [x for own in enumerate(texts) for x in rows([own])]
    for x in together:
        assert x["least_gap"] == min((b - a for a, b in zip(x["start"], x["start"][1:], strict=False)), default=None)
        assert x["least_length"] == min((b - a for a, b in zip(x["start"], x["end"], strict=True)), default=None)


def test_worklist_looks_through_lively_parts_only(spark, monkeypatch):
    """The parts left out hold nothing: what has a position is the same as among all findings, and as without leaving any out."""
    from pyspark.sql import functions as F

    from seqloom.operators import gestures

    tempos = ["TEMPO 120 4 4 0", "TEMPO 60 4 4 0", "TEMPO 240 3 4 0", "TEMPO 120 4 4 0\n<TEMPOENVEX\nPT 0 30 0\nPT 1 300 0\n>"]
    files = []
    for i in range(160):
        r = random.Random(i)
        tick, notes = 0, []
        for _ in range(r.choice([1, 2, 12])):
            length = r.choice([60, 61, 115, 116, 15, 29, 400])
            notes.append((tick, tick + length, r.randrange(60, 65)))
            tick += r.choice([length, 115, 116, 58, 800])
        text = "\n".join(["<REAPER_PROJECT", tempos[i % 4], file_queries.track_text("clavi", "0 0", file_queries.CHAIN, file_queries.event_lines(notes))])
        files.append((f"/p/{i}.RPP", bytearray(text.encode())))
    p = Projects(spark.createDataFrame(files, "path string, content binary").coalesce(1))
    found = lambda: sorted(tuple(x) for x in lint.located(p).collect())
    some, parts = found(), p.timed_parts
    left = parts.select(gestures.lively().alias("x")).where("x").count()
    assert 0 < left < 160 and some == sorted(tuple(x) for x in lint.lint(p).where("tick IS NOT NULL").collect())
    monkeypatch.setattr(gestures, "lively", lambda: F.lit(True))
    monkeypatch.setattr(gestures, "_calm", lambda ends, *_: [False] * (len(ends) - 1))
    assert some and found() == some


def test_worklist_plans_nothing_but_located_findings(spark):
    """One pass: no table of tracks, their states or names is planned for findings without a position; tempo is worked out before parts are left out."""
    plan = catalogue.QUERIES["q_file_worklist"](spark, DIR)._jdf.queryExecution()
    assert "malformed" not in plan.analyzed().toString() and "Generate explode(array(coalesce(" in plan.optimizedPlan().toString()
