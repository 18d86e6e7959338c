"""fundlens: campaign and text analytics expressed as Spark DataFrame plans.

Every public operator is a function ``DataFrame -> DataFrame`` (or a small
builder around one) so that Catalyst sees one declarative plan and can prune,
push down and fuse it.  See ``README.md`` for the operator inventory.
"""

from fundlens.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
