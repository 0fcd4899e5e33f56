"""DataFrame-to-DataFrame transforms, the same for batch and stream unless said."""
