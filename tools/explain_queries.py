"""Write the formatted physical plan of registered queries to docs/plans/.

usage: python tools/explain_queries.py [sf_dir] [name ...]   (default: the bench's headline queries)
Plans are taken after one execution, so AQE's final plan is shown.
"""
import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from medallion.catalogue import queries  # noqa: E402
from medallion.session import build_session, checkpoint_dir  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or HEADLINE
    spark = build_session()
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    qs = queries()
    for name in names:
        df = qs[name](spark, sf)
        df.collect()  # runs this frame's own plan, so its final adaptive plan is explained
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        ckpt = checkpoint_dir(spark).rstrip("/")
        text = buf.getvalue().replace(sf, "<sf_dir>").replace(ckpt, "<spark.checkpoint.dir>")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(f"# {name} at {os.path.basename(sf.rstrip('/'))}, after one run (AQE final plan)\n\n")
            f.write(text)
        print(name, len(text))


if __name__ == "__main__":
    main()
