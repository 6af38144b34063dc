"""python -m glyphloom list | explain NAME FOLDER | run NAME FOLDER OUT: the registered core queries."""

from __future__ import annotations

import argparse


def main() -> None:
    from glyphloom.plans import checks as _  # noqa: F401 - adds its queries
    from glyphloom.plans.queries import QUERIES
    from glyphloom.session import local_session

    parser = argparse.ArgumentParser(prog="glyphloom", description=__doc__)
    parser.add_argument("action", choices=("list", "explain", "run"))
    parser.add_argument("name", nargs="?", choices=sorted(QUERIES), metavar="NAME")
    parser.add_argument("folder", nargs="?", help="folder of the tables")
    parser.add_argument("out", nargs="?", help="folder for the result")
    args = parser.parse_args()
    if args.action == "list":
        print("\n".join(sorted(QUERIES)))
        return
    if not args.folder or args.action == "run" and not args.out:
        parser.error("the folder of the tables, and for run one for the result, must be given")
    df = QUERIES[args.name](local_session(), args.folder)
    if args.action == "explain":
        df.explain("formatted")
    else:
        df.write.parquet(args.out)


if __name__ == "__main__":
    main()
