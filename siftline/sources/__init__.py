"""Reading record logs, bounded and streaming, and choosing where to start."""
