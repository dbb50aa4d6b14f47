"""Sources, sinks and profiling."""
from kindred.sources.session import get_session, checkpoint_dir, scratch_path  # noqa: F401
