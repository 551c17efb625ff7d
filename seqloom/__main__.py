"""python -m seqloom lint|fix-slides|splits|import|check|render|build PATH: thin commands over the plans; exit codes 0 fine, 1 findings, 2 no input."""

from __future__ import annotations

import argparse
import json
import shutil
import sys
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

from seqloom.plans import assemble, lint, render, rewrite
from seqloom.sources.projects import Projects, project_files, stem_of


def listed(problems) -> int:
    """Prints violations; 1 if there are any."""
    n = 0
    for n, r in enumerate(problems.orderBy("id", "check", "message").toLocalIterator(), 1):
        print(f"{r.id}: check {r.check}: {r.message}")
    print(f"{n} problem(s)")
    return int(n > 0)


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="seqloom", description=__doc__)
    verbs = parser.add_subparsers(dest="verb", required=True)
    a = verbs.add_parser("lint")
    a.add_argument("folder")
    a.add_argument("--vocabulary")
    for flag in ("--allow-slide-ramps", "--allow-polyphonic-slides", "--no-warnings"):
        a.add_argument(flag, action="store_true")
    b = verbs.add_parser("fix-slides")
    b.add_argument("folder")
    b.add_argument("--bend-range", type=int, default=12)
    b.add_argument("--track", action="append")
    b.add_argument("--dry-run", action="store_true")
    b.add_argument("--report")
    c = verbs.add_parser("splits")
    c.add_argument("folder")
    c.add_argument("--test-fraction", type=float, default=0.2)
    c.add_argument("-o", "--out", help="corpus folder whose stored splits hold and are updated")
    d = verbs.add_parser("check")
    d.add_argument("folder")
    e = verbs.add_parser("import")
    e.add_argument("folder")
    e.add_argument("-o", "--out", required=True)
    e.add_argument("--render-provenance", required=True)
    e.add_argument("--test-fraction", type=float, default=0.2)
    e.add_argument("--renderer", default="REAPER (manual render)")
    e.add_argument("--exceptions")
    for flag in ("--allow-slide-ramps", "--allow-polyphonic-slides"):
        e.add_argument(flag, action="store_true")
    f = verbs.add_parser("render")
    f.add_argument("folder")
    f.add_argument("--out-dir")
    f.add_argument("--format", choices=["flac", "wav"], default="flac")
    f.add_argument("--sample-rate", type=int, default=44_100)
    f.add_argument("--channels", type=int, default=1)
    f.add_argument("--reaper-binary", default="reaper")
    f.add_argument("--timeout", type=int, default=300)
    f.add_argument("--force", action="store_true")
    g = verbs.add_parser("build")
    g.add_argument("folder")
    g.add_argument("-o", "--out", required=True)
    g.add_argument("--synthesiser", default="fluidsynth")
    g.add_argument("--sample-rate", type=int, default=44_100)
    g.add_argument("--tail-seconds", type=float, default=2.0)
    g.add_argument("--gain", type=float, default=0.6)
    g.add_argument("--keep-stems", action="store_true")
    o = parser.parse_args(args)
    for name in ("vocabulary", "exceptions"):
        if getattr(o, name, None) and not Path(getattr(o, name)).exists():
            print(f"no {name} file at {getattr(o, name)}", file=sys.stderr)
            return 2

    spark = SparkSession.builder.appName("seqloom").getOrCreate()
    if o.verb == "check":
        if not Path(o.folder, "manifest.jsonl").exists():
            print(f"no manifest in {o.folder}", file=sys.stderr)
            return 2
        return listed(assemble.check_corpus(spark, o.folder))
    files = project_files(spark, o.folder).cache()
    if files.isEmpty():
        print("no projects found", file=sys.stderr)
        return 2
    projects = Projects(files)
    if o.verb == "splits":
        ids = files.select(stem_of(files.path).alias("id"))
        found = {r.id: r.split for r in assemble.splits_for(spark, ids, o.test_fraction, o.out or o.folder).orderBy("id").toLocalIterator()}
        if o.out:
            assemble.store_splits(assemble.stored_splits(o.out) | found, o.out)
        print(json.dumps(found, indent=1))
        return 0
    if o.verb == "import":
        try:
            sidecar = assemble.read_sidecar(o.render_provenance)
        except ValueError as error:
            print(error, file=sys.stderr)
            return 2
        audio = assemble.read_binary(spark, o.folder, "*.wav").unionByName(assemble.read_binary(spark, o.folder, "*.flac"))
        exceptions = json.loads(Path(o.exceptions).read_text()) if o.exceptions else None
        done = assemble.import_corpus(files, audio, o.out, sidecar, o.renderer, o.test_fraction, exceptions, o.allow_slide_ramps, o.allow_polyphonic_slides)
        for r in done.errors.orderBy("path").toLocalIterator():
            print(f"FAIL {r.path}: {r.error}")
        print(f"{done.rows.count()} example(s) imported to {o.out}")
        return listed(done.problems) or int(not done.errors.isEmpty())
    if o.verb == "render":
        s = render.Mixdown(Path(o.reaper_binary), o.sample_rate, o.channels, o.format, o.timeout)
        failed = 0
        out = o.out_dir or o.folder
        there = assemble.read_binary(spark, out, f"*.{o.format}").select(F.concat(F.lit(out.rstrip("/") + "/"), F.regexp_extract("path", "([^/]*)$", 1)).alias("path"))
        for r in render.pending(files, there, out, o.format, o.force).orderBy("path").toLocalIterator():
            try:
                print("OK  ", render.render(Path(r.path.removeprefix("file:")), Path(r.output), s))
            except (render.RenderError, OSError) as error:
                failed += 1
                print("FAIL", error)
        return int(failed > 0)
    if o.verb == "build":
        s = render.Synthesis(o.sample_rate, o.tail_seconds, o.gain)
        with tempfile.TemporaryDirectory() as work:  # the programs run on this machine
            try:
                for path, wav in assemble.synthesised(projects, f"{o.out}/audio", work, s, o.synthesiser).items():
                    print("OK  ", path, wav)
            except render.RenderError as error:
                print(error, file=sys.stderr)
                return 2
            if o.keep_stems:
                shutil.copytree(work, Path(o.out, "stems"), dirs_exist_ok=True)
        return 0
    if o.verb == "fix-slides":
        report = rewrite.write(rewrite.verified(projects, rewrite.plan(projects, o.bend_range, o.track), not o.track), o.dry_run)
        if o.report:
            with open(o.report, "w") as f:
                json.dump(report, f, indent=1)
        for r in report:
            print(r)
        return int(any(r["error"] for r in report))
    words = spark.read.text(o.vocabulary, wholetext=True).selectExpr("explode(from_json(value, 'array<string>')) AS word") if o.vocabulary else None
    found = lint.lint(projects, words, o.allow_slide_ramps, o.allow_polyphonic_slides, not o.no_warnings).cache()
    for r in lint.statuses(projects, found).orderBy("path").toLocalIterator():
        print(f"{r.status:4} {r.path}  {r.parts} part(s), {r.problems} problem(s), {r.warnings} warning(s)")
    for r in found.where("tick IS NULL").select("path", "message").unionByName(lint.worklist(found).select("path", "message")).toLocalIterator():
        print(f"     {r.path}: {r.message}")
    return lint.exit_code(found)


if __name__ == "__main__":
    sys.exit(main())
