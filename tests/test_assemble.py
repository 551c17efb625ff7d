"""Import, check, stored splits and the synthesiser's files on a small folder."""

import json
from pathlib import Path

import numpy as np
import pytest

from seqloom import __main__ as command
from seqloom.plans import assemble
from seqloom.sources import media

SIDECAR = {"schema_version": "procgen.reaper-render-provenance/v1", "repositories": {k: "abc" for k in "abcd"}, "template": {"id": "t", "version": "1"}, "vst_profiles": [{"id": "p", "version": "2"}], "aliases": [], "event_policy": {}}


def project(names, notes="E 0 90 3c 40\nE 480 80 3c 00"):
    tracks = "\n".join(f'<TRACK\nNAME "{n}"\n<FXCHAIN\n<JS tool\n>\n>\n<ITEM\nHASDATA 1 480 QN\n{notes}\n>\n>' for n in names)
    return f"<REAPER_PROJECT\nTEMPO 120 4 4 0\n{tracks}\n>\n"


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    ramp = "\n".join(f"E 0 90 {60 + k:02x} 40\nE 20 80 {60 + k:02x} 00" for k in range(9)) + "\nE 0 90 45 40\nE 480 80 45 00"
    for name, text in {"a": project(["electric-guitar-clean", "drums"]), "b": project(["electric-guitar-clean"], ramp), "c": project(["electric-guitar-clean"]), "d": project(["electric-guitar-clean"])}.items():
        (folder / f"{name}.RPP").write_text(text)
        if name != "c":
            (folder / f"{name}.wav").write_bytes(media.wav_bytes(np.linspace(-0.5, 0.5, 66_150), 44_100))
    (tmp_path / "sidecar.json").write_text(json.dumps(SIDECAR))
    return folder


def test_import_and_check(spark, source, tmp_path, capsys):
    out = str(tmp_path / "out")
    assert command.main(["import", str(source), "-o", out, "--render-provenance", str(tmp_path / "sidecar.json"), "--test-fraction", "0"]) == 1
    assert "b.RPP: 1 slide gesture(s)" in capsys.readouterr().out
    rows = {r["source_midi_id"]: r for f in Path(out, "manifest.jsonl").glob("*.json") for r in map(json.loads, f.read_text().splitlines())}
    assert {k: r["id"] for k, r in rows.items()} == {"a": "ex_0001", "d": "ex_0003"}  # c has no audio, b leaves a gap
    a = rows["a"]
    assert Path(out, a["audio_path"]).read_bytes() == (source / "a.wav").read_bytes() and Path(out, a["midi_path"]).read_bytes()[:4] == b"MThd"
    assert json.loads(Path(out, a["provenance_path"]).read_text())["example_id"] == "ex_0001"
    assert a["tail_seconds"] == 1.0 and assemble.stored_splits(out) == {"a": "train", "b": "train", "d": "train"}
    assert command.main(["check", out]) == 0
    Path(out, a["midi_path"]).unlink()
    assert command.main(["check", out]) == 1 and "check 7" in capsys.readouterr().out
    assert command.main(["check", str(tmp_path)]) == 2 and command.main(["import", str(source), "-o", out, "--render-provenance", "none"]) == 2


def test_stored_splits_hold(spark, tmp_path):
    assemble.store_splits({"a": "test", "gone": "train"}, str(tmp_path))
    ids = spark.createDataFrame([(x,) for x in "abcdef"], "id string")
    got = {r.id: r.split for r in assemble.splits_for(spark, ids, 0.4, str(tmp_path)).collect()}
    assert got["a"] == "test" and sum(got[x] == "test" for x in "bcdef") == 2 and "gone" not in got


def test_part_midi_order():
    data = assemble.part_midi([(0, 480, 60, 90), (480, 960, 60, 80)], [(0, 500_000), (480, 400_000)], 480, 0, 130, 5, 2.0)
    ppq, messages = media.midi_messages(data)
    own = [(t, s, a) for _, t, s, a, *_ in messages if s != 0xFF or a == 0x51]
    assert ppq == 480 and own == [(0, 0xFF, 0x51), (0, 0xB0, 0), (0, 0xB0, 32), (0, 0xC0, 5), (0, 0x90, 60), (480, 0xFF, 0x51), (480, 0x80, 60), (480, 0x90, 60), (960, 0x80, 60), (960 + 2400, 0xB0, 123)]
