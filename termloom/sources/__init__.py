"""Where documents come from: trees of files, or tables that hold texts."""
