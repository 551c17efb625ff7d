"""Rendering by outside programs: arguments and scripts as plain text, the program itself given as a function.

Which projects still need a render is an anti-join in Spark; the programs run on the driver, one project at a time.
"""

from __future__ import annotations

import json
import subprocess
import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, functions as F

from seqloom.sources import media
from seqloom.sources.projects import stem_of


class RenderError(RuntimeError):
    """A render that failed, or whose file is not what was asked for."""


@dataclass(frozen=True)
class Synthesis:
    """Settings of the part-by-part synthesis."""

    sample_rate: int = 44_100
    tail_seconds: float = 2.0
    gain: float = 0.6
    reverb: bool = False
    chorus: bool = False
    peak_dbfs: float = -1.0

    @property
    def normalization(self) -> str:
        return f"peak:{self.peak_dbfs:g}dBFS"

    @property
    def effects(self) -> str:
        switch = {True: "on", False: "off"}
        return f"reverb={switch[self.reverb]},chorus={switch[self.chorus]}"


@dataclass(frozen=True)
class Mixdown:
    """Settings of a workstation's own render."""

    binary: Path
    sample_rate: int = 44_100
    channels: int = 1
    suffix: str = "flac"
    timeout: int = 300
    #: Output format as the workstation stores it (base64); depends on the installation.
    format_code: str = ""


def pending(projects: DataFrame, existing: DataFrame, out_dir: str, suffix: str, force: bool = False) -> DataFrame:
    """path, output of the projects that have no output yet."""
    x = projects.select("path", F.concat(F.lit(out_dir.rstrip("/") + "/"), stem_of(F.col("path")), F.lit("." + suffix)).alias("output"))
    return x if force else x.join(existing.select(F.col("path").alias("output")), "output", "left_anti")


def script(folder: str, stem: str, s: Mixdown, blank: str) -> str:
    """The workstation's render script: whole project, no stems, then a blank project so that it can quit unasked."""
    text = lambda v: json.dumps(v, ensure_ascii=False)  # noqa: E731  a JSON string is a Lua string but for \u
    numbers = {"RENDER_SETTINGS": 0, "RENDER_BOUNDSFLAG": 1, "RENDER_CHANNELS": s.channels, "RENDER_SRATE": s.sample_rate}
    strings = {"RENDER_FORMAT": s.format_code, "RENDER_FILE": folder, "RENDER_PATTERN": stem}
    lines = [f"reaper.GetSetProjectInfo(0, {text(k)}, {v}, true)" for k, v in numbers.items()]
    lines += [f"reaper.GetSetProjectInfo_String(0, {text(k)}, {text(v)}, true)" for k, v in strings.items()]
    lines += ["reaper.Main_OnCommand(42230, 0)", f"reaper.Main_openProject({text('noprompt:' + blank)})", "reaper.Main_OnCommand(40004, 0)"]
    return "\n".join([*lines, ""])


def arguments(s: Mixdown, project: Path, script_path: Path) -> list[str]:
    return [str(s.binary), "-newinst", "-nosplash", str(project), str(script_path), "-closeall:nosave:exit"]


def problems(data: bytes, s: Mixdown) -> list[str]:
    """What is wrong with a rendered file."""
    info = media.audio_info(data)
    if not info:
        return ["neither WAV nor FLAC"]
    out = [f"{info['channels']} channels, expected {s.channels}"] if info["channels"] != s.channels else []
    out += [f"{info['sample_rate']} Hz, expected {s.sample_rate}"] if info["sample_rate"] != s.sample_rate else []
    return out + (["no samples"] if not info["frames"] else ["silent"] if info["silent"] else [])


def render(project: Path, output: Path, s: Mixdown, run: Callable[[list[str], int], None] | None = None) -> Path:
    """Renders one project; raises RenderError unless the file is there and sound."""
    run = run or (lambda command, timeout: subprocess.run(command, check=True, timeout=timeout) and None)
    output.parent.mkdir(parents=True, exist_ok=True)
    output.unlink(missing_ok=True)
    with tempfile.TemporaryDirectory() as folder:
        blank, lua = Path(folder, "blank.RPP"), Path(folder, "render.lua")
        blank.write_text('<REAPER_PROJECT 0.1 "7.0" 0\n>\n')
        lua.write_text(script(str(output.parent), output.stem, s, str(blank)), encoding="utf-8")
        try:
            run(arguments(s, project, lua), s.timeout)
        except subprocess.TimeoutExpired as e:
            raise RenderError(f"{project.name}: not done within {s.timeout} s") from e
        except subprocess.CalledProcessError as e:
            raise RenderError(f"{project.name}: the program ended with {e.returncode}") from e
    if not output.exists():
        raise RenderError(f"{project.name}: no file came out")
    if found := problems(output.read_bytes(), s):
        raise RenderError(f"{project.name}: {'; '.join(found)}")
    return output
