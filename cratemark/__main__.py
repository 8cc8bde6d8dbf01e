"""One refresh: ``python -m cratemark``, or ``spark-submit`` with this file."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from cratemark import Store, Tables, feature_documents, playlists, publish, refresh
from cratemark.session import build_session


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cratemark", description=refresh.__doc__)
    parser.add_argument("--playlists", required=True, nargs="+", help="files, folders or globs")
    parser.add_argument("--documents", required=True, nargs="+", help="feature documents, likewise")
    parser.add_argument("--output", required=True, help="folder of the tables")
    parser.add_argument("--playlist-id", help="take this playlist only")
    parser.add_argument(
        "--id-from", choices=("document", "file_name", "folder"), default="document"
    )
    parser.add_argument("--lines", action="store_true", help="one document per line, not per file")
    parser.add_argument("--malformed", choices=("fail", "skip"), default="fail")
    parser.add_argument("--append", action="store_true", help="add to the result")
    parser.add_argument("--partition-by-category", action="store_true")
    parser.add_argument("--compact", action="store_true", help="even out the output files")
    parser.add_argument(
        "--versions", action="store_true", help="make --output a store, in which all tables change at once"
    )
    parser.add_argument("--run", help="name of the run, with --versions; repeating it is safe")
    options = parser.parse_args(arguments)
    if options.run and not options.versions:
        parser.error("--run needs --versions")

    spark = build_session()
    landed = (
        playlists(
            spark,
            options.playlists,
            lines=options.lines,
            id_from=options.id_from,
            malformed=options.malformed,
        ),
        feature_documents(spark, options.documents, lines=options.lines),
    )
    how = {
        "playlist_id": options.playlist_id,
        "malformed": options.malformed,
        "result_mode": "append" if options.append else "overwrite",
        "partition_by": "category" if options.partition_by_category else None,
        "compact": options.compact,
    }
    if options.versions:
        publish(spark, *landed, Store(spark, options.output), run=options.run, **how)
    else:
        refresh(spark, *landed, Tables.under(options.output), **how)


if __name__ == "__main__":
    main()
