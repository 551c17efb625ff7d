"""Planning the rewrite of a project file, and a second pass over the result."""

from test_projects import CHAIN, events, projects, track

from seqloom.plans import rewrite
from seqloom.sources.projects import Projects

SLIDE = [(i * 20, i * 20 + 16, 60 + i) for i in range(9)] + [(180, 660, 69)]


def test_rewrite(spark):
    wide = [(i * 20, i * 20 + 16, 40 + i) for i in range(20)] + [(400, 880, 60)]
    p = projects(spark, newline="\r\n", a=[track("electric-guitar-clean", CHAIN, [*events(SLIDE), "E 100 b0 7b 00"]), track("violin", CHAIN, events([(0, 480, 60)]))], b=[track("electric-guitar-clean", CHAIN, events(wide))], c=[track("violin", CHAIN, events([(0, 480, 60)]))])
    rows = {r.path[3]: r for r in rewrite.plan(p).collect()}
    assert (rows["a"].gestures, rows["a"].notes_before, rows["a"].notes_after, rows["a"].error) == (1, 11, 2, None)
    assert "semitones" in rows["b"].error and rows["b"].content is None and rows["c"].content is None
    text = bytes(rows["a"].content)
    assert b"\n" not in text.replace(b"\r\n", b"")
    again = Projects(spark.createDataFrame([("/p/a.RPP", bytearray(text))], "path string, content binary"))
    assert [(r.start, r.end, r.pitch) for r in again.notes.where("track = 1").collect()] == [(0, 660, 69)]
    assert again.audits.where("track = 1").first().bends_missing_rpn == 0
    assert [r.gestures for r in rewrite.plan(again).collect()] == [0]
    assert again.events.agg({"tick": "max"}).first()[0] == p.events.where("path = '/p/a.RPP'").agg({"tick": "max"}).first()[0]
