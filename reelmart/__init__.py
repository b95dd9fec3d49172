"""reelmart: video-platform report marts built as lazy PySpark DataFrame transforms."""
