"""Sources and sinks: raw posts, the brand x day panel, model runs, crawled pages."""

from dealcast.sources.tables import table  # noqa: F401
from dealcast.sources.posts import POSTS_SCHEMA, deals_view, read_posts, write_posts  # noqa: F401
from dealcast.sources.panel import read_panel, write_panel  # noqa: F401
