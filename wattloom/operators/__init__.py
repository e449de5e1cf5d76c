"""DataFrame operators over readings and intervals."""
