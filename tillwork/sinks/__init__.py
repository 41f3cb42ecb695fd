"""Writers: catalog tables and the small CSV export."""
