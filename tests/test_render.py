"""Rendering with the program replaced by a function; preflight on small projects."""

import subprocess

import numpy as np
import pytest
from test_projects import CHAIN, events, projects, track

from seqloom.plans import preflight, render
from seqloom.sources import media


def test_render(tmp_path):
    s = render.Mixdown(tmp_path / "bin", suffix="wav")
    tone = media.wav_bytes(np.sin(np.arange(100)).astype(np.float32), 44_100)
    calls = []

    def good(command, timeout):
        calls.append((command, timeout, open(command[4], encoding="utf-8").read()))
        (tmp_path / "Pamiętasz.wav").write_bytes(tone)

    assert render.render(tmp_path / "Pamiętasz.RPP", tmp_path / "Pamiętasz.wav", s, good).exists()
    command, timeout, lua = calls[0]
    assert command[1:3] == ["-newinst", "-nosplash"] and timeout == 300 and "Pamiętasz" in lua and "\\u" not in lua

    def silent(command, timeout):
        (tmp_path / "x.wav").write_bytes(media.wav_bytes(np.zeros(10, np.float32), 48_000))

    def late(command, timeout):
        raise subprocess.TimeoutExpired(command, timeout)

    for run, words in ((silent, "48000 Hz"), (late, "300 s"), (lambda c, t: None, "no file")):
        with pytest.raises(render.RenderError, match=words):
            render.render(tmp_path / "x.RPP", tmp_path / "x.wav", s, run)
    assert render.Synthesis().normalization == "peak:-1dBFS" and render.Synthesis().effects == "reverb=off,chorus=off"


def test_pending(spark):
    p = spark.createDataFrame([("/p/a.RPP",), ("/p/b.RPP",)], "path string")
    done = spark.createDataFrame([("/out/a.flac",)], "path string")
    assert [r.output for r in render.pending(p, done, "/out", "flac").collect()] == ["/out/b.flac"]


def test_preflight(spark):
    p = projects(spark, a=[track("violin | take", CHAIN, events([(0, 480, 12), (0, 480, 52)])), track("violin | two", CHAIN, events([(0, 480, 12), (0, 480, 52)]))], b=[track("viola | x", CHAIN, events([(0, 480, 60)]))])
    aliases = spark.createDataFrame([("violin", "take"), ("violin", "two")], "canonical_name string, renderer_track string")
    schema = "canonical_name string, action string, ranges array<struct<low: int, high: int>>"
    errors, kept, audit = preflight.preflight(p, aliases, spark.createDataFrame([(None, "remove", [(0, 20)])], schema))
    assert [(r.path, r.error) for r in errors.collect()] == [("/p/b.RPP", "unattested renderer label: viola | x")]
    assert sorted((r.path, r.track, r.pitch) for r in kept.collect()) == [("/p/a.RPP", 1, 52), ("/p/b.RPP", 1, 60)]
    assert {r.keyswitch_notes for r in audit.where("path = '/p/a.RPP'").collect()} == {1}
    errors, _, _ = preflight.preflight(p, aliases, spark.createDataFrame([(None, "reject", [(0, 20)])], schema))
    assert sum("key-switch" in r.error for r in errors.collect()) == 2
