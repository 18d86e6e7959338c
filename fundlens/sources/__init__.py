from fundlens.sources.tables import TABLES, table
from fundlens.sources.views import campaigns, votes

__all__ = ["TABLES", "table", "campaigns", "votes"]
