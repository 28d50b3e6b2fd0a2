"""Landing-directory streams that feed the keyed tables."""
