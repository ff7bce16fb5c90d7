"""Command line for the daily job (E6, E7), for ``spark-submit``:

    spark-submit --py-files itemwise.zip -m itemwise \\
        --features db.user_features --dictionary db.items --table-out db.recs \\
        --sample-rate 1.0 --top-n 10 --top-k 10 --normalize true

Replaces the original six positional arguments (partition count, output
table, sample rate, N, K, normalise); the partition count is left to AQE.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from .config import RecConfig
from .plans.jobs import run_recommendations


def _bool(text: str) -> bool:
    if text.lower() in ("true", "1", "yes"):
        return True
    if text.lower() in ("false", "0", "no"):
        return False
    raise argparse.ArgumentTypeError(f"not a boolean: {text!r}")


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    d = RecConfig()
    p = argparse.ArgumentParser(prog="itemwise", description="item-to-item recommendations")
    p.add_argument("--features", required=True, help="feature table name or parquet path")
    p.add_argument("--dictionary", required=True, help="item dictionary table name or path")
    p.add_argument("--table-out", required=True, help="output table, partitioned by stat_date")
    p.add_argument("--stat-date", type=int, help="yyyyMMdd; default: yesterday")
    p.add_argument("--as-of", type=dt.date.fromisoformat, help="run as if today were this date")
    p.add_argument("--sample-rate", type=float, default=d.sample_rate)
    p.add_argument("--sample-seed", default=d.sample_seed)
    p.add_argument("--sample-exact", type=_bool, default=d.sample_exact,
                   help="keep exactly floor(users x rate) users")
    p.add_argument("--top-n", type=int, default=d.top_n)
    p.add_argument("--top-k", type=int, default=d.top_k)
    p.add_argument("--normalize", type=_bool, default=d.normalize)
    p.add_argument("--scoring", choices=["candidate", "source"], default=d.scoring)
    p.add_argument("--label", choices=["code", "name"], default=d.label)
    p.add_argument("--missing-label", choices=["drop", "empty", "error"], default=d.missing_label)
    p.add_argument("--layout", choices=["source_recom", "user_watched", "scored_list"],
                   default=d.layout)
    p.add_argument("--dedup", type=_bool, default=d.dedup)
    p.add_argument("--lenient", type=_bool, default=d.lenient)
    p.add_argument("--trailing-separator", type=_bool, default=d.trailing_separator)
    p.add_argument("--block-size", type=int, default=d.block_size)
    return p.parse_args(argv)


def config_from(args: argparse.Namespace) -> RecConfig:
    return RecConfig(sample_rate=args.sample_rate, sample_seed=args.sample_seed,
                     sample_exact=args.sample_exact,
                     top_n=args.top_n, top_k=args.top_k, normalize=args.normalize,
                     scoring=args.scoring, label=args.label, missing_label=args.missing_label,
                     layout=args.layout, block_size=args.block_size, dedup=args.dedup,
                     lenient=args.lenient, trailing_separator=args.trailing_separator)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parse_args(argv)
    session = spark or SparkSession.builder.appName("itemwise").getOrCreate()
    day = run_recommendations(session, args.features, args.dictionary, args.table_out,
                              config_from(args), args.stat_date, args.as_of)
    print(f"wrote {args.table_out} partition stat_date={day}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
