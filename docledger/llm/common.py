"""What the operators of this subpackage share."""

from ..shared import cut, new_path, release, shared_dir

__all__ = ["cut", "new_path", "release", "shared_dir"]
