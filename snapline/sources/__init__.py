"""Sources: feed subscription, raw files, history, logs, pages, topic watermarks."""
