from smelter.sources.files import Entry, list_folder, read_bronze, read_table
from smelter.sources.views import register_bronze, register_tables, show_views, view_name

__all__ = [
    "Entry",
    "list_folder",
    "read_bronze",
    "read_table",
    "register_bronze",
    "register_tables",
    "show_views",
    "view_name",
]
