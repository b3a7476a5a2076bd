"""Named reports, the derived inputs they run on, and their oracle SQL."""
