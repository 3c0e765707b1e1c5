"""Command line: run the scorecard on a directory of source files.

    python -m holecard --code-base DIR --out DIR [--completions PARQUET]
                       [--train-ratio 0.8] [--seed 0] [--split-strategy random|by_module]
                       [--lines 10] [--tokens 10] [--methods 10] [--format parquet|csv]

Without ``--completions`` the stand-in model (repeat the previous line) fills
the holes; a completions table needs ``prompt_id, sample_idx, completion``.
"""

from __future__ import annotations

import argparse

from holecard.plans import scorecard
from holecard.session import build_session
from holecard.sources.corpus import scan_source_files


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="holecard")
    ap.add_argument("--code-base", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--completions")
    ap.add_argument("--master")
    ap.add_argument("--train-ratio", type=float, default=0.8)
    ap.add_argument("--seed", type=int, default=0)
    ap.add_argument("--split-strategy", default="random", choices=["random", "by_module"])
    ap.add_argument("--lines", type=int, default=10)
    ap.add_argument("--tokens", type=int, default=10)
    ap.add_argument("--methods", type=int, default=10)
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    cfg = scorecard.RunConfig(train_ratio=args.train_ratio, seed=args.seed,
                              split_strategy=args.split_strategy, lines_prompts_count=args.lines,
                              tokens_prompts_count=args.tokens, methods_prompts_count=args.methods,
                              output_directory=args.out)
    files = scan_source_files(spark, args.code_base)
    completions = spark.read.parquet(args.completions) if args.completions else None
    run_dir = scorecard.run_staged(spark, files, cfg, args.out, completions=completions, fmt=args.format)
    summary = spark.read.parquet(f"{scorecard.stages_dir(run_dir, args.format)}/summary")
    summary.show(truncate=False, vertical=True)
    print(run_dir)
    spark.stop()


if __name__ == "__main__":
    main()
