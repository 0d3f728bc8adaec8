"""Part of voxloom."""
