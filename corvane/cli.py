"""python -m corvane.cli build|gold|report|inspect|sample ..."""

from __future__ import annotations

import argparse
import importlib
import os
import sys
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane import logs
from corvane.config import SPLITS, CorpusConfig, ReaderSettings, check_speaker
from corvane.errors import CorvaneError
from corvane.functions.text import fmt_size
from corvane.operators import profile, state
from corvane.plans import build, corpus
from corvane.sources import manifest, metadata

FOLDERS = (("root", ""), ("bronze", "bronze"), ("silver", "silver"), ("shards", "silver/shards"), ("metadata", "silver/metadata"), ("gold", "gold"), ("state", "state"), ("logs", "logs"))


def inspect(spark: SparkSession, root: str) -> str:
    """A text about a dataset: its folders, shards (names and sizes), metadata, manifests and state. No media are read, no archives opened,
    and no path above the dataset is named."""
    lines = [f"dataset: {os.path.basename(root.rstrip('/'))}"]
    for name, part in FOLDERS:
        e = metadata.entries(spark, f"{root}/{part}")
        n = profile.entry_counts(e).first()
        lines.append(f"[{name}] {n['dirs']} folders, {n['files']} files")
        lines += [f"  {r['name']}/" if r["is_dir"] else f"  {r['name']} ({r['text']})" for r in profile.preview(e).withColumn("text", fmt_size(F.col("size"))).collect()]
    shards = metadata.entries(spark, f"{root}/silver/shards").select(F.col("name").alias("path"), "size")
    total = profile.shard_totals(shards).withColumn("text", fmt_size(F.col("bytes"))).first()
    lines.append(f"[shards by size] {total['shards']} archives, {total['text']}")
    lines += [f"  {r['name']} ({r['text']})" for r in profile.shard_inventory(shards).withColumn("text", fmt_size(F.col("size"))).collect()]
    lines += [f"  ... and {total['shards'] - 40} more"] if total["shards"] > 40 else []
    names = sorted((x for x in _names(f"{root}/silver/metadata") if x.lower().endswith(".json")), key=str.lower)
    lines.append(f"[metadata documents] {len(names)}")
    lines += described(metadata.documents(spark, [f"{root}/silver/metadata/{x}" for x in names[:2]]), samples=True)
    lines.append("[manifests]")
    sizes = {r["name"]: r["text"] for r in metadata.entries(spark, f"{root}/gold").withColumn("text", fmt_size(F.col("size"))).collect()}
    for name in [x for x in _names(f"{root}/gold") if x.endswith(".csv")][:12]:
        columns, rows = profile.csv_profile(manifest.table(spark, f"{root}/gold/{name}"))
        lines += [f"  {name} ({sizes[name]}): {', '.join(columns)}", *(f"    {r.asDict()}" for r in rows.collect())]
    lines.append("[splits]")
    lines += described(metadata.documents(spark, [f"{root}/gold/split_metadata.json"]))
    lines.append("[state]")
    lines += described(metadata.documents(spark, [f"{root}/state/processing_state.json"]))
    return "\n".join(lines) + "\n"


def sample(spark: SparkSession, settings: ReaderSettings, split: str, index: int) -> str:
    """A text about one utterance: its manifest row, what its shard has of it, and its decoded audio. One archive is read."""
    rows = corpus.at(spark, settings, split, index)
    r = rows.first()
    if r is None:
        raise IndexError(f"{split} has no row {index}")
    s = corpus.read_samples(spark, settings, split, [r["speaker_id"]]).where((F.col("speaker_id") == r["speaker_id"]) & (F.col("utterance_id") == r["utterance_id"])).first()
    lines = [f"{k}: {r[k]}" for k in ("speaker_id", "utterance_id", "shard_member_prefix", "frame_count", "audio_sample_rate")]
    if s is None or s["error"]:
        return "\n".join([*lines, f"error: {s['error'] if s else 'too few frames'}"]) + "\n"
    frames = s["frames"]
    lines += [f"frames: {len(frames)} ({', '.join(map(str, list(frames)[:10]))}{' ...' if len(frames) > 10 else ''}), {sum(map(len, frames.values()))} bytes", f"audio: {len(s['samples'])} samples"]
    lines += [f"{k}: {s[k]:.3f} s" for k in ("video_duration_sec", "decoded_audio_sec", "duration_gap_sec")]
    return "\n".join(lines + ["the gap is over 80 ms"] * bool(s["gap_warning"])) + "\n"


def _names(folder: str) -> list[str]:
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def described(docs: DataFrame, samples: bool = False) -> list[str]:
    """Lines about docs(path, json)."""
    rows = profile.json_profile(docs).orderBy("path").collect()
    objects, speakers, statuses = (f(docs).collect() for f in (profile.json_objects, profile.json_speakers, profile.json_statuses))
    out = [] if rows else ["  (not found)"]
    for r in rows:
        if not r["readable"] or r["root_keys"] is None:
            out.append(f"  {r['path']}: " + ("no JSON object" if r["readable"] else "can't be read as JSON"))
            continue
        out.append(f"  {r['path']}: {', '.join(r['root_keys'])}")
        out += [f"    {k}: {r[k]}" for k in profile.SCALARS if r[k] is not None]
        out += [f"    {o['key']}: {', '.join(o['keys'])}; {o['numbers']}" for o in objects if o["path"] == r["path"]]
        out += [f"    {s['key']}: {s['count']}" + (f" ({', '.join(s['ids'])})" if s["ids"] else "") for s in speakers if s["path"] == r["path"]]
        mine = {s["status"]: s["n"] for s in statuses if s["path"] == r["path"]}
        out += [f"    speakers: {sum(mine.values())}; {mine}"] if mine else []
        if r["samples"] is not None:
            out.append(f"    samples: {r['samples']}" + (f"; keys of the first: {', '.join(r['sample_keys'])}" if samples and r["sample_keys"] else ""))
            out += [f"    fields of the first: {r['sample_fields']}"] if samples and r["sample_fields"] else []
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corvane")
    sub = p.add_subparsers(dest="what", required=True)
    b = sub.add_parser("build", help="archives to shards, metadata, state and Gold")
    who = b.add_mutually_exclusive_group(required=True)
    who.add_argument("--speaker")
    who.add_argument("--all", action="store_true")
    who.add_argument("--gold-only", action="store_true", help="no speaker; Gold from the metadata that are there")
    b.add_argument("--root", required=True)
    b.add_argument("--workspace", help="folder that the driver and all executors share, for what is made on the way; spark.checkpoint.dir unless given")
    b.add_argument("--allow-partial-gold", action="store_true", help="Gold too if speakers aren't done")
    b.add_argument("--media", help="module:name of a plans.build.Media; not needed for a dry run")
    b.add_argument("--force", action="store_true", help="also speakers whose artefacts verify")
    b.add_argument("--limit-utterances", type=int, default=0)
    b.add_argument("--dry-run", action="store_true", help="stop before archives are opened")
    b.add_argument("--log-level", default="INFO", choices=["DEBUG", "INFO", "WARNING", "ERROR"])
    g = sub.add_parser("gold")
    g.add_argument("--root", required=True)
    g.add_argument("--allow-partial", action="store_true")
    g.add_argument("--seed", type=int, default=42)
    r = sub.add_parser("report")
    r.add_argument("--root")
    r.add_argument("--out", required=True)
    s = sub.add_parser("sample")
    s.add_argument("--root")
    s.add_argument("--split", choices=SPLITS, default="train")
    s.add_argument("--index", type=int, default=0, help="negative ones count from the end")
    i = sub.add_parser("inspect")
    i.add_argument("--root", required=True)
    i.add_argument("--out")
    return p


def run_build(spark: SparkSession, a: argparse.Namespace) -> int:
    c = CorpusConfig(root=a.root)
    log = logs.configure(a.log_level, f"{c.root}/logs/build.log")
    try:
        speakers = c.usable() if a.all or a.gold_only else [check_speaker(a.speaker, c)]
        build.check_store(c)
        if a.workspace:
            spark.sparkContext.setCheckpointDir(a.workspace)
        if a.gold_only:
            return 0 if corpus.build_gold(spark, c, a.allow_partial_gold) else 1
        media = None
        if a.media:
            module, _, name = a.media.partition(":")
            media = getattr(importlib.import_module(module), name)
        elif not a.dry_run:
            raise ValueError("give --media, or --dry-run")
        states = build.build(spark, c, speakers, media, a.force, a.limit_utterances or None, a.dry_run)
    except (ValueError, ImportError, AttributeError, CorvaneError) as e:
        log.error("%s", e)
        return 1
    except KeyboardInterrupt:
        log.warning("interrupted; the state is kept")
        return 130
    for r in profile.status_histogram(states).orderBy("status").collect():
        log.info("%s: %d", r["status"], r["n"])
    if a.allow_partial_gold and not a.dry_run and not state.all_done(states):
        corpus.build_gold(spark, c, True)
    return 0


def main(args: list[str] | None = None) -> int:
    p = parser()
    a = p.parse_args(args)
    if a.what == "inspect" and a.out and f"{a.out}/".startswith(f"{a.root.rstrip('/')}/"):
        p.error("the output must lie outside the dataset")
    spark = SparkSession.builder.appName("corvane").getOrCreate()
    if a.what == "build":
        return run_build(spark, a)
    if a.what == "gold":
        return 0 if corpus.build_gold(spark, CorpusConfig(root=a.root, split_seed=a.seed), a.allow_partial) else 1
    if a.what in ("report", "sample"):
        settings = ReaderSettings.from_env()
        if not (a.root or settings.data_root):
            p.error("no dataset: give --root or set it in the environment")
        if a.what == "sample":
            sys.stdout.write(sample(spark, replace(settings, data_root=a.root or settings.data_root), a.split, a.index))
        else:
            print("\n".join(corpus.report(spark, settings, a.out, a.root).values()))
        return 0
    text = inspect(spark, a.root)
    if a.out:
        with open(a.out, "w", encoding="utf-8") as f:
            f.write(text)
    else:
        sys.stdout.write(text)
    return 0


if __name__ == "__main__":
    sys.exit(main())
