"""Report bundles: several operators planned together over shared inputs."""
