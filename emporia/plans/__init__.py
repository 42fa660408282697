"""Named pipelines built from the operators (GMV/Top-N, log metrics,
reports, change data, warehouse layers, page links)."""
