"""``spark-submit``-able entry point: ``python -m wordloom <job> …``."""

from __future__ import annotations

import argparse

from wordloom.plans import jobs
from wordloom.session import session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wordloom")
    top.add_argument("--master", help="only where the submit command sets none")
    sub = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, *positional: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=(run.__doc__ or "").splitlines()[0])
        p.set_defaults(run=run)
        for arg in positional:
            p.add_argument(arg, type=int if arg.endswith("distance") else str)
        return p

    def with_stages(p: argparse.ArgumentParser) -> argparse.ArgumentParser:
        p.add_argument("--max-line", type=int, help="leave out lines of so many bytes, line ends counted")
        p.add_argument("--counters", help="folder for the record counters of the stages")
        return p

    p = job("merge", jobs.merge_corpus, "source", "output")
    p.add_argument("--max-line", type=int, help="leave out lines of so many bytes, line ends counted")
    p = with_stages(job("count-words", jobs.count_words, "source", "output", "stopwords"))
    p.add_argument("--min-len", type=int, default=1)
    p.add_argument("--as-written", action="store_true", help="stopwords are trimmed, not lower-cased")
    p = job("rank-words", jobs.rank_words, "counts", "output")
    p.add_argument("--k", type=int, default=50)
    p = with_stages(job("pairs", jobs.count_pairs, "source", "output", "top", "distance"))
    p.add_argument("--min-len", type=int, default=1)
    p = with_stages(job("stripes", jobs.count_stripes, "source", "output", "top", "distance"))
    p.add_argument("--min-len", type=int, default=2)
    p.add_argument("--keep-empty", action="store_true")
    p = job("sweep", jobs.sweep_pairs, "source", "output", "top")
    p.add_argument("--max-distance", type=int, default=4)
    p.add_argument("--min-len", type=int, default=1)
    p = job("document-frequency", jobs.count_documents,
            "source", "output", "top_output", "stopwords")
    p.add_argument("--k", type=int, default=100)
    p.add_argument("--tie", choices=("asc", "desc"), default="asc")
    p.add_argument("--whole-files", action="store_true")
    p = job("tf-idf", jobs.score_documents, "source", "output", "df_list")
    p.add_argument("--n-docs", type=int)
    p.add_argument("--whole-files", action="store_true")
    job("add-counts", jobs.add_counts, "earlier", "batch", "output")
    job("add-stripes", jobs.add_stripes, "earlier", "batch", "output")
    p = job("score-corpus", jobs.score_corpus, "source", "work", "stopwords")
    p.add_argument("--k", type=int, default=100)
    p.add_argument("--tie", choices=("asc", "desc"), default="asc")
    p.add_argument("--n-docs", type=int)
    p.add_argument("--whole-files", action="store_true")
    p.add_argument("--fresh", action="store_true", help="run finished steps again")
    return top


def main(argv: list[str] | None = None) -> None:
    args = vars(parser().parse_args(argv))
    run, name, master = args.pop("run"), args.pop("job"), args.pop("master")
    for step in run(session(f"wordloom-{name}", master), **args) or ():
        print(*step, sep="\t")


if __name__ == "__main__":
    main()
