"""Dataset operators over keyed tables."""
