"""Registry, transforms, entity loads, scope loads and reports."""
